"""Values that results depend on, stated as they are: domains, labels, bands, weights and templates."""

# --- fixed values -----------------------------------------------------------
ORDER_STATUSES = [
    "approved", "canceled", "created", "delivered",
    "invoiced", "processing", "shipped", "unavailable",
]
PAYMENT_TYPES = ["boleto", "credit_card", "debit_card", "not_defined", "voucher"]
STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO",
    "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
    "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]
REGION_STATES = {
    "Sudeste": ["SP", "RJ", "MG", "ES"],
    "Sul": ["PR", "SC", "RS"],
    "Nordeste": ["BA", "PE", "CE", "MA", "PB", "PI", "RN", "AL", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Norte": ["AM", "PA", "AC", "AP", "RO", "RR", "TO"],
}
MONTH_NAMES_PT = [
    "Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
DAY_NAMES_PT = ["Domingo", "Segunda", "Terca", "Quarta", "Quinta", "Sexta", "Sabado"]
PAYMENT_LABELS = {
    "credit_card": "Cartão de Crédito",
    "boleto": "Boleto Bancário",
    "voucher": "Voucher",
    "debit_card": "Cartão de Débito",
}
PAYMENT_LABEL_OTHER = "Outros"
FUNNEL = [
    ("created", "Criado"),
    ("approved", "Aprovado"),
    ("processing", "Em Processamento"),
    ("invoiced", "Faturado"),
    ("shipped", "Enviado"),
    ("delivered", "Entregue"),
    ("canceled", "Cancelado"),
    ("unavailable", "Indisponível"),
]
WEIGHT_BANDS = [
    (500, "Leve (ate 500g)"),
    (2000, "Medio (500g-2kg)"),
    (10000, "Pesado (2kg-10kg)"),
]
WEIGHT_BAND_TOP = "Muito Pesado (10kg+)"
PRICE_TIERS = [(20, "Budget"), (50, "Mid-range")]
PRICE_TIER_TOP = "Premium"
ETL_BOX = {"lat": (-35.0, 6.0), "lng": (-74.0, -34.0)}
DQ_BOX = {"lat": (-33.75, 5.27), "lng": (-73.99, -28.85)}
SELLER_SCORE_WEIGHTS = {"revenue": 0.50, "rating": 0.35, "dispatch": 0.15}
DQ_DIMENSION_WEIGHTS = {
    "completeness": 0.30, "uniqueness": 0.25, "validity": 0.20,
    "consistency": 0.15, "timeliness": 0.10,
}
EXTRACTED_FIELDS = [
    "brand", "category", "color", "features", "keywords",
    "material", "subcategory", "target_audience", "target_device",
]
PRODUCT_CATEGORIES = [
    "Phone Accessories", "Electronics", "Clothing", "Home & Kitchen",
    "Audio", "Smart Home", "Beauty & Personal Care", "Drinkware",
    "Sports & Outdoors", "Computers & Accessories", "Footwear",
    "Health & Household", "Office Products", "Cleaning Supplies",
    "Skincare", "Kitchen & Dining",
]
TOKEN_PRICE_PER_MILLION = {"input": 0.15, "output": 0.60}
IMAGE_PRICE = 0.04
COST_SCALES = [100, 1_000, 10_000, 100_000]
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
UNACCENTED = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"
# characters after which initcap starts a new word (besides white space)
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"
# --- end of fixed values ----------------------------------------------------

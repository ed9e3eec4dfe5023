"""PII (3), DataFrame functions only: detected entities are replaced by keyed, type-consistent surrogates.

Detection is one alternation of patterns (`PATTERN`): addresses of mail, phone, card, bank account, social security and IP
numbers, access keys, and names behind a title. Two spellings are one entity if their normal forms agree: lower case for
mail and keys, letters and digits only for numbers, all eight groups for IPv6, gender and one word for names: every word of a
name is an entity of its own, so "Mr John Smith" and a later "Mr Smith" get the same surname.

A surrogate is drawn from a keyed hash of (type, normal form, attempt): digits become digits, letters become letters of
their script, case and punctuation stay; cards keep the issuer digit and a valid check digit, phones the country code, IP
octets stay in range; names keep title, number of words and script and end as names of their gender do. Distinct entities
must get distinct surrogates, none of which is the normal form of a real entity: the drawing is repeated with the next
attempt for those that collide, until none does. The supply has no bound: with the attempts, names get more syllables and
mails a longer local part; should all numbers of a format be taken, further digits follow (an IPv6 address for an IPv4 one). Hence every occurrence in every document gets the same surrogate.

Only entities are shuffled, first grouped by form. Documents without an entity pass without a shuffle; those with one meet
the list of their own replacements by a key of id and text.

Defined cases: NULL and empty texts pass unchanged; rows without an id are treated like others; repeated rows get the same
result, an empty table an empty one; texts of any length are read whole. All other columns are kept; columns must not be named
`__mark` or `__new`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm import common as C

KEY = "corpus-surrogates-1"
#: Attempts after which names and mails, and after which other entities grow by one more character or syllable.
GROW, GROW_FORMAT = 4, 16

# --- fixed values: titles and their gender, alphabets, patterns ----------------
MALE = ["Mr", "Herr", "Señor", "Senor", "Sr", "Monsieur", "Don"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Senora", "Sra", "Señorita", "Senorita", "Madame", "Mme", "Mlle", "Doña", "Dona"]
OTHER = ["Dr", "Prof"]
DIGITS, LATIN = "0123456789", "abcdefghijklmnopqrstuvwxyz"
GREEK, CYRILLIC = "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзиклмнопрстуфхцчшэюя"
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fa", "ga", "ha", "ka", "ke", "la", "le", "li", "lo", "ma", "me", "mi", "na", "ne", "no", "ra", "re", "ri", "sa", "se", "ta", "te", "to", "va", "ve", "za"],
    "greek": ["βα", "γε", "δα", "δο", "θα", "κα", "κο", "λα", "λε", "μα", "με", "νι", "νο", "πα", "ρα", "σι"],
    "cyrillic": ["ба", "ва", "во", "га", "да", "до", "ка", "ко", "ла", "ли", "ма", "ми", "на", "не", "ра", "та"],
}
ENDINGS = {
    "latin": {"m": "nos", "f": "lia", "n": "ren"},
    "greek": {"m": "νος", "f": "νια", "n": "ρι"},
    "cyrillic": {"m": "лов", "f": "лова", "n": "ко"},
}

# the first letters are looked at before anything else, as the pattern is tried at every character
_TITLES = "(?:" + "|".join(MALE + FEMALE + OTHER) + r")\.?"
GAP = r"[ \t\x{A0}]++"
TITLE = r"(?=[" + "".join(sorted({t[0] for t in MALE + FEMALE + OTHER})) + r"])(?<!\p{L})(?:" + _TITLES + r"(?:[ \t\x{A0}]|\r?\n)++)+"
# a word of a name: O'Brien, d'Angelo, al-Rashid, Mary-Jane, McDonald, LOPEZ (without a possessive 's); J. or J before another
INITIAL = r"(?:\p{Lu}\.-?)+(?=" + GAP + r"\p{L}|\p{Lu}\p{L})|\p{Lu}(?=" + GAP + r"\p{Lu})"
WORD = r"(?:\p{L}{1,2}['’]|\p{Ll}{2,3}-)?\p{Lu}[\p{L}\p{M}]++(?:(?:['’](?!S(?!\p{L}))(?=\p{Lu})|-(?=\p{L}))[\p{L}\p{M}]++)*+"
PARTICLE = r"(?:de|da|do|di|del|della|der|den|des|dos|das|du|la|las|los|le|lo|el|al|van|von|vom|zu|zur|zum|ten|ter|te|bin|ben|ibn|bint|af|av|y|e)" + GAP
_NAMED = r"(?:" + PARTICLE + r"){0,4}(?!" + _TITLES + r"(?!\p{L}))(?:" + INITIAL + "|" + WORD + ")"
NAME = _NAMED + "(?:(?:" + GAP + r"|(?<=\.))" + _NAMED + ")*"
# the words of a name that are replaced; particles and blanks stay
NAME_WORD = r"(?<![\p{L}\p{M}'’\-])(?:(?:\p{Lu}\.-?)+|" + WORD + r"|\p{Lu}(?![\p{L}\p{M}]))"
_H, _V4 = "[0-9A-Fa-f]{1,4}", r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_GROUPED = "|".join(f"0[0-9]{{1,4}}(?:{c}[0-9]{{2,8}}){{1,5}}" for c in (" ", r"\.", "-", "/"))
KINDS = {
    "mail": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+",
    "name": TITLE + NAME,
    "key": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|(?:sk|pk|ghp|xox[bp])[_\-][\p{Alnum}_\-]{16,}|AKIA[0-9A-Z]{16})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .\-]?[0-9]{2,4}){2,4}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}.\-/])(?:1[ .\-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .\-])[0-9]{3}[ .\-][0-9]{4}(?![\p{L}\p{N}\-])|(?<![\p{L}\p{N}.\-/])(?=0(?:[ .\-/]?[0-9]){8,12}(?![ .\-/]?[0-9]))(?:" + _GROUPED + r")(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}\-])",
    "card": r"(?<![\p{L}\p{N}])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3})(?![\p{L}\p{N}])",
    "ip6": r"(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:" + _H + ":){7}" + _H + r"|(?=(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Fa-f:]))(?:" + _H + "(?::" + _H + ")*+)?::(?:" + _H + "(?::" + _H + r")*+)?|::(?:[Ff]{4}:)?" + _V4 + r")(?![\p{L}\p{N}:]|\.[0-9])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Every entity holds one of these, most texts none: a quick first look.
HINT = r"[0-9@]|" + TITLE + r"\p{L}|(?:sk|pk|ghp|xox[bp])[_\-]\p{Alnum}|AKIA[A-Z]|[a-fA-F]{32}"
BARE = r"[^\p{L}\p{N}]"


def letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_of(form: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS.items()):
        out = F.when(form.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def gender_of(form: Column) -> Column:
    title = F.regexp_extract(form, r"^(\p{L}+)", 1)
    return F.when(title.isin(MALE), "m").when(title.isin(FEMALE), "f").otherwise("n")


def normal_form(kind: Column, form: Column) -> Column:
    return (
        F.when(kind.isin("mail", "key", "ip"), F.lower(form))
        .when(kind == "ip6", groups_of(F.lower(form)))
        .otherwise(F.lower(F.regexp_replace(form, BARE, "")))
    )


def groups_of(address: Column) -> Column:
    """An IPv6 address with all its groups of four digits; one that ends in an IPv4 address stays."""
    some = lambda text: F.filter(F.split(text, ":"), lambda g: g != "")
    left, right = some(F.substring_index(address, "::", 1)), some(F.substring_index(address, "::", -1))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right))
    groups = F.when(address.contains("::"), F.concat(left, zeros, right)).otherwise(some(address))
    return F.when(address.contains("."), address).otherwise(F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ":"))


def words_of(form: Column) -> Column:
    """The replaced words of a name, without its titles."""
    return F.regexp_extract_all(F.regexp_replace(form, f"^{TITLE}", ""), F.lit(NAME_WORD), F.lit(0))


def stream(kind: Column, normal: Column, attempt: Column, key: str) -> Column:
    """Keyed hex digits, four for every character of the normal form."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(normal) / 16).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, normal, attempt, b), 256)), "")


def drawn(hexes: Column, i: Column, n: int) -> Column:
    """Number below n at place i of a stream."""
    return (F.conv(F.substring(hexes, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % n).cast("int")


def pick(alphabet: str, hexes: Column, i: Column) -> Column:
    return F.substring(F.lit(alphabet), drawn(hexes, i, len(alphabet)) + 1, F.lit(1))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string that lacks its check digit."""
    reverse = F.reverse(letters(digits))
    twice = lambda d: F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
    each = F.transform(reverse, lambda c, i: F.when(i % 2 == 0, twice(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def with_check_digit(digits: Column) -> Column:
    head = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return let(head, lambda h: F.concat(h, ((10 - luhn_sum(h) % 10) % 10).cast("string")))


def passes_luhn(digits: Column) -> Column:
    return (luhn_sum(F.substring(digits, F.lit(1), F.length(digits) - 1)) + F.substring(digits, F.length(digits), F.lit(1)).cast("int")) % 10 == 0


def substituted(normal: Column, hexes: Column, fixed: Column, held: Column) -> Column:
    """Every letter and digit beyond the first `fixed` replaced within its class; the rest stays. Where `held` is true,
    so do places 4 to 6 (the exchange of a fictional phone number)."""

    def one(c: Column, i: Column) -> Column:
        return (
            F.when((i < fixed) | (held & (i >= 4) & (i <= 6)), c)
            .when(c.rlike("[0-9]"), pick(DIGITS, hexes, i))
            .when(c.rlike(r"\p{IsGreek}"), pick(GREEK, hexes, i))
            .when(c.rlike(r"\p{IsCyrillic}"), pick(CYRILLIC, hexes, i))
            .when(c.rlike(r"\p{L}"), pick(LATIN, hexes, i))
            .otherwise(c)
        )

    return F.array_join(F.transform(letters(normal), one), "")


def further(hexes: Column, n: Column, digits: bool) -> Column:
    """n more digits or letters of a stream."""
    to = DIGITS + "012345" if digits else LATIN[:16]
    one = lambda i: F.translate(F.substring(F.sha2(F.concat_ws("\x1f", hexes, i), 256), 1, 1), "0123456789abcdef", to)
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one), "")).otherwise("")


def named(normal: Column, hexes: Column, more: Column) -> Column:
    """A word of three syllables and `more`, with the ending of its gender, in the script of `normal`."""
    gender = F.substring(normal, 1, 1)

    def word(script: str) -> Column:
        syllables, ends = SYLLABLES[script], ENDINGS[script]
        one = lambda k: F.get(F.array(*map(F.lit, syllables)), drawn(F.sha2(F.concat_ws("\x1f", hexes, k), 256), F.lit(0), len(syllables)))
        parts = F.transform(F.sequence(F.lit(0), more + 2), one)
        end = F.when(gender == "m", ends["m"]).when(gender == "f", ends["f"]).otherwise(ends["n"])
        return F.concat(F.array_join(parts, ""), end)

    of_script = F.when(normal.rlike(r"\p{IsGreek}"), word("greek")).when(normal.rlike(r"\p{IsCyrillic}"), word("cyrillic")).otherwise(word("latin"))
    return F.concat(gender, F.lit(":"), of_script)


def surrogate(kind: Column, normal: Column, attempt: Column, fixed: Column, key: str = KEY) -> Column:
    """The normal form that stands in for `normal` at the given attempt."""

    grown = lambda each: F.floor(attempt / each).cast("int")

    def body(hexes: Column) -> Column:
        fictional = (kind == "phone") & normal.rlike("^1[0-9]{3}555[0-9]{4}$") & (attempt < 4)
        plain = substituted(normal, hexes, F.when(kind == "card", F.lit(1)).when(kind == "iban", F.lit(2)).otherwise(fixed), fictional)
        octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (drawn(hexes, i, 254) + 1).cast("string")), ".")
        hexed = F.substring(F.concat(hexes, F.sha2(hexes, 256)), F.lit(1), F.length(normal))
        at = F.instr(normal, "@")
        ending = F.regexp_extract(normal, r"\.[^.@]+$", 0)
        mail = F.concat(further(hexes, grown(GROW), False), F.substring(plain, F.lit(1), F.length(plain) - F.length(ending)), ending)
        more = further(hexes, grown(GROW_FORMAT), True)
        groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(F.sha2(hexes, 256), i * 4 + 1, F.lit(4))), ":")
        return (
            F.when((kind == "ip") & (attempt < GROW_FORMAT), octets)
            .when(kind.isin("ip", "ip6"), groups)
            .when(kind == "name", named(normal, hexes, grown(GROW)))
            .when((kind == "key") & normal.rlike("^[0-9a-f]+$"), F.concat(hexed, more))
            .when((kind == "mail") & (at > 0), mail)
            .when((kind == "card") & passes_luhn(normal), with_check_digit(F.concat(plain, more)))
            .otherwise(F.concat(plain, more))
        )

    return let(stream(kind, normal, attempt, key), body)


def written(kind: Column, form: Column, standin: Column) -> Column:
    """The surrogate in the spelling of `form`: its case and punctuation."""
    kept = F.regexp_replace(standin, BARE, "")
    more = F.greatest(F.length(kept) - F.length(F.regexp_replace(form, BARE, "")), F.lit(0))
    # what a stand-in has more than its form comes first in a mail, else last
    ahead, behind = F.when(kind == "mail", more).otherwise(0), F.when(kind == "mail", 0).otherwise(more)
    bare = letters(F.substring(kept, ahead + 1, F.length(kept)))
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"))

    spelled = let(bare, lambda b: F.aggregate(letters(form), start, lambda s, c: _put(b, s, c), lambda s: s["out"]))
    whole = F.concat(F.substring(kept, F.lit(1), ahead), spelled, F.substring(kept, F.length(kept) - behind + 1, behind))
    return F.when(kind.isin("ip", "ip6"), standin).otherwise(whole)


def written_name(form: Column, standins: Column) -> Column:
    """Titles, particles and blanks of `form` with the stand-ins of its words, in order."""
    title = F.regexp_extract(form, f"^{TITLE}", 0)
    between = F.split(F.substring(form, F.length(title) + 1, F.length(form)), NAME_WORD, -1)
    parts = F.zip_with(between, standins, lambda a, b: F.concat(a, F.initcap(F.coalesce(F.substring(b, 3, 1 << 20), F.lit("")))))
    return F.concat(title, F.array_join(parts, ""))


def _put(bare: Column, s: Column, c: Column) -> Column:
    sub = F.get(bare, s["i"])
    cased = F.when(c.rlike(r"\p{Lu}"), F.upper(sub)).otherwise(sub)
    mark = c.rlike(BARE)
    return F.struct(F.when(mark, s["i"]).otherwise(s["i"] + 1).alias("i"), F.concat(s["out"], F.when(mark, c).otherwise(cased)).alias("out"))


def assigned(forms: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, normal, standin), one row per entity: distinct within a kind and never the normal form of a real entity."""
    code = F.length(F.regexp_extract("form", r"^\+([0-9]{1,3})[ .\-(]", 1))
    entities = forms.groupBy("kind", "normal").agg(F.max(F.when(F.col("kind") == "phone", code).otherwise(0)).alias("fixed"))
    entities = C.staged(entities, "entities")
    real = entities.select("kind", F.col("normal").alias("standin"))
    pending, done, attempt = entities, [], 0
    while attempt == 0 or not pending.isEmpty():
        tried = pending.withColumn("standin", surrogate(F.col("kind"), F.col("normal"), F.lit(attempt), F.col("fixed"), key))
        free = tried.join(real, ["kind", "standin"], "left_anti")
        for earlier in done:
            free = free.join(earlier.select("kind", "standin"), ["kind", "standin"], "left_anti")
        first = Window.partitionBy("kind", "standin").orderBy("normal")
        won = free.withColumn("_place", F.row_number().over(first)).where("_place = 1").select("kind", "normal", "standin")
        done.append(C.staged(won, "standins"))
        pending = C.staged(pending.join(done[-1], ["kind", "normal"], "left_anti"), "pending")
        attempt += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def replaced(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """`docs` with every entity in `text` replaced; with `count`, a column of that name holds how many."""
    kept = docs.columns
    text = F.col("text")
    mark = F.md5(F.concat_ws("\x1f", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    has = F.coalesce(text.rlike(HINT) & text.rlike(PATTERN), F.lit(False))
    forms_in = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    found = C.staged(docs.where(has).select(mark.alias("__mark"), F.explode(F.array_distinct(forms_in)).alias("form")), "found")
    kinds = found.groupBy("form").agg(F.lit(1).alias("_")).select("form", kind_of(F.col("form")).alias("kind"))
    kinds = C.staged(kinds, "kinds")
    kind, form = F.col("kind"), F.col("form")
    plain = kinds.where("kind <> 'name'").select("form", "kind", F.lit(0).alias("at"), normal_form(kind, form).alias("normal"))
    words = kinds.where("kind = 'name'").select("form", "kind", F.posexplode(words_of(form)).alias("at", "word"))
    named_words = words.select("form", "kind", "at", F.concat(gender_of(form), F.lit(":"), F.lower("word")).alias("normal"))
    forms = C.staged(plain.unionAll(named_words), "forms")
    met = C.staged(forms.join(assigned(forms, key), ["kind", "normal"]).select("form", "kind", "at", "standin"), "met")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "standin"))), lambda x: x["standin"])
    names = met.where("kind = 'name'").groupBy("form").agg(ordered.alias("standins")).select("form", written_name(form, F.col("standins")).alias("new"))
    spelled = met.where("kind <> 'name'").select("form", written(kind, form, F.col("standin")).alias("new")).unionAll(names)
    # a document's own list of replacements
    own = found.distinct().join(C.staged(spelled, "spelled"), "form").groupBy("__mark").agg(F.map_from_entries(F.collect_list(F.struct("form", "new"))).alias("__new"))
    hit = docs.where(has).withColumn("__mark", mark).join(own, "__mark")
    between = F.split(text, PATTERN, -1)
    parts = F.zip_with(between, F.transform(forms_in, lambda f: F.element_at(F.col("__new"), f)), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    columns = [F.array_join(parts, "").alias("text") if c == "text" else F.col(c) for c in kept]
    extra = [F.size(forms_in).alias(count)] if count else []
    none = [F.lit(0).alias(count)] if count else []
    return hit.select(*columns, *extra).unionAll(docs.where(~has).select(*kept, *none))

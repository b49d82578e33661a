"""Personal data replaced by keyed surrogates of the same kind. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import reliable, unused

# What counts as a mention, by kind; the first kind that matches somewhere wins.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_MALE = r"Mr|Sir|Herrn?|Señor|Sr(?=\.)|Monsieur|M(?=\.)|господину?|г-ну?"
_FEMALE = r"Mrs|Ms|Miss|Frau|Señora|Señorita|Sra|Srta|Madame|Mademoiselle|Mme|Mlle|госпож[ае]|г-ж[ае]"
_NEUTRAL = r"Dr|Prof|Mx"
_TITLE = rf"(?:{_FEMALE}|{_MALE}|{_NEUTRAL})\.?\s"
# An apostrophe belongs to a word if more than a possessive s follows.
_NAME_WORD = r"\p{Lu}[\p{L}\p{M}-]*+(?:['’](?!s(?![\p{L}\p{M}]))[\p{L}\p{M}-]++)*+"
# Words that begin a sentence behind a name or are written large as they are, so they
# do not continue a name; parts of names that do not count as words of theirs; and names that are
# words, too. The last two are not looked for without a title.
_COMMON = (
    "A And As At But By For From He Her His How I If In It Its My Not Of On Or Our She That The Their Then"
    " There These They This To We What When Where Who Why With You Your Can Could Did Does Has Have Is Must"
    " Shall Should Was Were Would Please Thanks Yes"
    " Monday Tuesday Wednesday Thursday Friday Saturday Sunday"
    " January February July September October November December"
    " Eine Er Sie Es Wir Ihr Ihre Ihren Ihrem Ihrer Ich Und Oder Aber Mein Sein Hat Ist Bitte Danke Wie Wenn"
    " Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag"
    " Une Il Elle Nous Vous Votre Et Mais Una Usted Sus Pero"
).split()
_PARTICLES = "Van Von De Der Den Del Della Di Da Dos La Le Ten Ter Bin Ibn Al El".split()
_BOTH = "Will May March April June August Mark Bill Grace Hope Rose Do An So No".split()
_MORE_WORD = rf"(?!(?:{'|'.join(_COMMON)})(?![\p{{L}}\p{{M}}'’-])){_NAME_WORD}"
# Digits as cards group them, the longer form first.
_CARD_FORMS = (
    r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,3}",
    r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}",
    r"\d{4}[ -]\d{6}[ -]\d{4,5}",
    r"\d{13,19}",
)
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
SECRET = (
    r"(?i:(?<![\p{L}\p{N}])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
    r"\s{0,3}[:=]\s{0,3}[\"']?)(?=[^\s\"']{0,99}\d)[^\s\"',;!?)]{5,}[^\s\"',;!?).]"
)
KINDS = {
    "secret": SECRET,
    "cloud key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "vendor key": r"(?<![A-Za-z0-9_])(?:[spr]k_(?:live|test)_[A-Za-z0-9]{10,}|gh[pousr]_[A-Za-z0-9]{20,})(?![A-Za-z0-9_])",
    "ipv6": (
        r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
        r"|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![0-9A-Za-z:])"
    ),
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "iban": rf"(?<![A-Za-z0-9]){_IBAN}(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": rf"(?<!\d)(?:{'|'.join(_CARD_FORMS)})(?!\d)",
    "phone": (
        r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
        r"|(?<![\d+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
    ),
    "name": rf"(?<![\p{{L}}\p{{N}}]){_TITLE}{_NAME_WORD}(?: (?:(?:{'|'.join(_PARTICLES)}) ){{0,2}}{_MORE_WORD}){{0,2}}",
}
MENTION = "|".join(f"(?:{p})" for p in KINDS.values())
# Kinds with a proof: only what passes it is a mention, so they are searched apart, see `_finder`.
_PROVEN = ("card", "iban")
_PLAIN = "|".join(f"(?:{p})" for name, p in KINDS.items() if name not in _PROVEN)
# Every mention has a digit or an @ or begins like this: one cheap look spares most texts the rest.
HINT = rf"[0-9@]|AKIA|ASIA|[spr]k_live_|[spr]k_test_|gh[pousr]_|{_TITLE}"
_DIGITS = ("ssn", "card", "phone")
# Letters that stand in for a letter of the same script, and syllables for names.
_ALPHABETS = {
    r"\p{IsCyrillic}": "абвгдежзиклмнопрстуфхцчшэюя",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHan}": "安白陈春达方高海家江开兰明宁平清文新玉志",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてと",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテト",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보",
    r"\p{IsArabic}": "ابتجدرسعفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve".split(),
    "cyrillic": "ба бе бо да де до га го ка ке ко ла ле ло ма ме мо на не но ра ре ро са со та те то ва ве".split(),
}
_ENDINGS = {
    ("latin", "given m"): ["n", "rt", "s"],
    ("latin", "given f"): ["lia", "na", "ra"],
    ("latin", "given n"): ["l", "ri", "x"],
    ("latin", "surname"): ["ner", "rds", "tti", "ll"],
    ("cyrillic", "given m"): ["н", "р", "л"],
    ("cyrillic", "given f"): ["лия", "на", "ра"],
    ("cyrillic", "given n"): ["ль", "ри"],
    ("cyrillic", "surname"): ["нко", "йчук", "рян"],
}
MAX_ROUNDS = 60


def _number(seed: Column, i: Column | int) -> Column:
    """The keyed number at place ``i`` of the stream of ``seed``."""
    at = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substring(F.md5(F.concat_ws("|", seed, at.cast("string"))), 1, 8), 16, 10).cast("long")


def _pick(choices: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, choices)), (n % len(choices) + 1).cast("int"))


def _picker(choices: list[str], seed: Column) -> Callable[[Column], Column]:
    return lambda i: _pick(choices, _number(seed, i))


def _reshaped(text: Column, seed: Column) -> Column:
    """Every letter and digit replaced by another of its kind, case and script; the rest stays."""
    hexadecimal = text.rlike("^[0-9a-f]{8,}$") | text.rlike("^[0-9A-F]{8,}$") | text.rlike("^[0-9a-f]+:[0-9a-f:]+$")

    def other(c: Column, i: Column) -> Column:
        n = _number(seed, i)
        latin = F.when(hexadecimal, n % 6).otherwise(n % 26)
        out = F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
        out = out.when(c.rlike("[a-z]"), F.char(latin + 97)).when(c.rlike("[A-Z]"), F.char(latin + 65))
        for script, letters in _ALPHABETS.items():
            mine = _pick(list(letters), n)
            out = out.when(c.rlike(script), F.when(c.rlike(r"\p{Lu}"), F.upper(mine)).otherwise(mine))
        out = out.when(c.rlike(r"\p{Lu}"), F.char(n % 26 + 65)).when(c.rlike(r"\p{L}"), F.char(n % 26 + 97))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), other), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    values = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _mod97(iban: Column) -> Column:
    """The remainder of an IBAN without blanks, its first four characters moved to its end."""
    moved = F.concat(F.substring(iban, 5, 40), F.substring(iban, 1, 4))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _is_card(mention: Column) -> Column:
    return _luhn(_digits(mention)) % 10 == 0


def _is_iban(mention: Column) -> Column:
    return _mod97(F.replace(mention, F.lit(" "), F.lit(""))) == 1


def _kind(mention: Column) -> Column:
    """The kind of a mention; NULL for a number that no card or account can have."""
    kind = None
    for name, pattern in KINDS.items():
        hit = mention.rlike(f"^(?:{pattern})$")
        if name in _PROVEN:
            hit = F.when(hit, _is_card(mention) if name == "card" else _is_iban(mention)).otherwise(False)
        kind = F.when(hit, F.lit(name)) if kind is None else kind.when(hit, F.lit(name))
    return kind.when(mention.rlike(f"^{_NAME_WORD}$"), F.lit("name"))


def _finder(body: Column) -> Column:
    """The pattern of a text's mentions: the kinds without a proof, and the text's own literals.

    Literals are the card and account numbers in the text that pass their proof, and the words of
    its names. Candidates may begin anywhere, also inside others, and one that fails takes no part,
    so it hides nothing. Of mentions that overlap the first counts, then the longer one.
    """
    none = F.array().cast("array<string>")

    def starts(before: str, form: str, after: str) -> Column:
        return F.regexp_extract_all(body, F.lit(f"{before}(?=({form}){after})"), F.lit(1))

    def prefixes(candidate: Column) -> Column:
        parts = F.split(candidate, " ")
        return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " "))

    cards = F.concat(*[starts(r"(?<!\d)", form, r"(?!\d)") for form in _CARD_FORMS])
    cards = F.when(body.rlike(KINDS["card"]), F.filter(F.array_distinct(cards), _is_card)).otherwise(none)
    ibans = F.flatten(F.transform(starts("(?<![A-Za-z0-9])", _IBAN, "(?![A-Za-z0-9])"), prefixes))
    ibans = F.filter(F.array_distinct(ibans), lambda m: m.rlike(f"^{_IBAN}$"))
    ibans = F.when(body.rlike(KINDS["iban"]), F.filter(ibans, _is_iban)).otherwise(none)
    words = F.flatten(F.transform(F.regexp_extract_all(body, F.lit(KINDS["name"]), F.lit(0)), _name_words))
    words = F.filter(F.array_distinct(words), lambda w: (F.length(w) > 1) & ~w.isin(_COMMON + _PARTICLES + _BOTH))
    words = F.when(body.rlike(KINDS["name"]), words).otherwise(none)

    def either(literals: Column, before: str, after: str, behind: bool = False) -> Column:
        # In falling order a longer literal stands before its own beginning.
        one = F.array_join(F.sort_array(literals, asc=False), "|")
        group = F.concat(F.lit(f"{before}(?:"), one, F.lit(f"){after}"))
        group = F.concat(F.lit("|"), group) if behind else F.concat(group, F.lit("|"))
        return F.when(F.size(literals) > 0, group).otherwise("")

    return F.concat(
        either(cards, r"(?<!\d)", r"(?!\d)"),
        either(ibans, "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"),
        F.lit(_PLAIN),
        either(words, r"(?<![\p{L}\p{N}\p{M}])", r"(?![\p{L}\p{N}\p{M}])", behind=True),
    )


def _secret_value(mention: Column) -> Column:
    return F.regexp_extract(mention, r"^[^:=]*[:=]\s*[\"']?(.*)$", 1)


def _name_words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, f"^{_TITLE}", ""), " ")


def _entities(kind: Column, mention: Column) -> Column:
    """The entities of a mention: [(kind, canonical form)]; a name has one for each word."""
    gender = F.when(mention.rlike(f"^(?:{_FEMALE})[.\\s]"), "f").when(mention.rlike(f"^(?:{_MALE})[.\\s]"), "m").otherwise("n")
    words = _name_words(mention)

    def word(w: Column, i: Column) -> Column:
        role = F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given "), gender))
        return F.struct(role.alias("kind"), F.lower(w).alias("entity"))

    form = F.when(kind.isin(*_DIGITS), _digits(mention)).when(kind.isin("email", "ipv6"), F.lower(mention))
    form = form.when(kind == "secret", _secret_value(mention))
    form = form.when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).otherwise(mention)
    single = F.array(F.struct(kind.alias("kind"), form.alias("entity")))
    return F.when(kind == "name", F.transform(words, word)).otherwise(single)


def _with_surrogate(rows: DataFrame, secret: str) -> DataFrame:
    """Add ``surrogate`` to (kind, entity, attempt)."""
    kind, entity = F.col("kind"), F.col("entity")
    seed = F.sha2(F.concat_ws("|", F.lit(secret), kind, entity, F.col("attempt").cast("string")), 256)
    rows = rows.withColumn("seed", seed)
    rows = rows.withColumn("shaped", _reshaped(entity, F.col("seed")))
    n, shaped, seed = F.length(entity), F.col("shaped"), F.col("seed")

    card = F.concat(F.substring(entity, 1, 1), F.substr(shaped, F.lit(2), n - 2))
    card = F.concat(card, ((10 - _luhn(F.concat(card, F.lit("0"))) % 10) % 10).cast("string"))
    octets = [_number(seed, 0) % 223 + 1, *[_number(seed, i) % 256 for i in (1, 2, 3)]]
    prefix = F.greatest(n - 10, F.lit(0))  # a country code stays
    phone = F.concat(
        F.substr(entity, F.lit(1), prefix),
        (_number(seed, 97) % 8 + 2).cast("string"),
        F.substr(shaped, prefix + 2, n),
    )
    country, account = F.substring(entity, 1, 2), F.substr(shaped, F.lit(5), n)
    proof = 98 - _mod97(F.concat(country, F.lit("00"), account))
    iban = F.concat(country, F.lpad(proof.cast("string"), 2, "0"), account)
    email = F.concat(F.regexp_extract(shaped, r"^(.*)\.[^.]+$", 1), F.regexp_extract(entity, r"\.[^.]+$", 0))

    out = F.when(kind == "card", card).when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
    out = out.when(kind == "phone", phone).when(kind == "iban", iban).when(kind == "email", email)
    out = out.when(kind == "cloud key", F.concat(F.substring(entity, 1, 4), F.substr(shaped, F.lit(5), n)))
    key = F.regexp_extract(entity, "^[a-z]+_(?:live_|test_)?", 0)
    out = out.when(kind == "vendor key", F.concat(key, F.substr(shaped, F.length(key) + 1, n)))
    # Every fourth attempt makes a name longer, so that there are names enough for any corpus.
    places = F.sequence(F.lit(1), F.lit(2) + F.floor(F.col("attempt") / 4).cast("int"))
    for script, syllables in _SYLLABLES.items():
        mine = entity.rlike(r"^\p{IsCyrillic}") if script == "cyrillic" else entity.rlike(r"^\p{IsLatin}")
        parts = F.transform(places, _picker(syllables, seed))
        for role in ("given m", "given f", "given n", "surname"):
            name = F.concat(F.array_join(parts, ""), _pick(_ENDINGS[script, role], _number(seed, 0)))
            out = out.when(mine & (kind == role), name)
    return rows.withColumn("surrogate", out.otherwise(shaped)).drop("seed", "shaped")


def surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): no two alike, none a real entity.

    Each round gives the open entities their next surrogate. One that another entity has, now or
    from an earlier round, or that occurs in the corpus itself, is not taken: of several that want
    one surrogate the least entity gets it, the others go on. The first round settles nearly all.
    """
    real = reliable(entities.select("kind", "entity").distinct())
    taken, pending, attempt = None, real, 0
    while True:
        wanted = _with_surrogate(pending.withColumn("attempt", F.lit(attempt)), secret).drop("attempt")
        first = wanted.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        used = real.select("kind", F.col("entity").alias("surrogate"))
        if taken is not None:
            used = used.union(taken.select("kind", "surrogate"))
        got = reliable(first.join(used, ["kind", "surrogate"], "left_anti").select("kind", "entity", "surrogate"))
        taken = got if taken is None else reliable(taken.union(got))
        pending = reliable(pending.join(got, ["kind", "entity"], "left_anti"))
        attempt += 1
        if pending.isEmpty():
            return taken
        if attempt == MAX_ROUNDS:
            raise RuntimeError(f"no distinct surrogates after {attempt} rounds")


def _rendered(kind: Column, mention: Column, found: Column) -> Column:
    """The mention with its surrogates in its own layout and case."""
    first = F.element_at(found, 1)

    def digit(a: Column, c: Column) -> Column:
        return F.when(
            c.rlike("[0-9]"),
            F.struct((a["n"] + 1).alias("n"), F.concat(a["s"], F.substr(first, a["n"], F.lit(1))).alias("s")),
        ).otherwise(F.struct(a["n"].alias("n"), F.concat(a["s"], c).alias("s")))

    start = F.struct(F.lit(1).alias("n"), F.lit("").alias("s"))
    digits = F.aggregate(F.split(mention, ""), start, digit, lambda a: a["s"])
    email = F.when(mention == F.upper(mention), F.upper(first)).otherwise(first)
    prefix = F.substr(mention, F.lit(1), F.length(mention) - F.length(_secret_value(mention)))
    grouped = F.when(F.contains(mention, F.lit(" ")), F.rtrim(F.regexp_replace(first, "(.{4})", "$1 "))).otherwise(first)

    def cased(s: Column, w: Column) -> Column:
        loud = (w == F.upper(w)) & (F.length(w) > 1)
        return F.when(loud, F.upper(s)).otherwise(F.initcap(s))

    names = F.array_join(F.zip_with(found, _name_words(mention), cased), " ")
    out = F.when(kind.isin(*_DIGITS), digits).when(kind.isin("email", "ipv6"), email)
    out = out.when(kind == "secret", F.concat(prefix, first)).when(kind == "iban", grouped)
    out = out.when(kind == "name", F.concat(F.regexp_extract(mention, f"^{_TITLE}", 0), names))
    return out.otherwise(first)


def _settled(parts: DataFrame) -> DataFrame:
    """``parts`` with one kind for each name word, whatever titles it has and wherever it stands.

    A given name keeps its titles' gender unless they differ.
    """
    named = F.col("kind").startswith("given ") | (F.col("kind") == "surname")
    has = {g: F.max(F.col("kind") == f"given {g}") for g in "fmn"}
    role = F.when(has["f"] & has["m"], "given n").when(has["f"], "given f").when(has["m"], "given m")
    role = role.when(has["n"], "given n").otherwise("surname")
    roles = parts.where(named).groupBy(F.col("entity").alias("word")).agg(role.alias("role"))
    parts = parts.join(roles, named & (F.col("entity") == F.col("word")), "left")
    return parts.select("mention", "at", F.coalesce("role", "kind").alias("kind"), "entity")


def replacements(mentions: DataFrame, secret: str) -> DataFrame:
    """(mention, replacement) for distinct ``mention``; mentions of no kind have no row."""
    kinds = mentions.select("mention").distinct().withColumn("kind", _kind(F.col("mention"))).where("kind IS NOT NULL")
    kinds = reliable(kinds)
    parts = kinds.select("mention", F.posexplode(_entities(F.col("kind"), F.col("mention"))).alias("at", "e"))
    parts = _settled(parts.select("mention", "at", "e.kind", "e.entity"))
    found = parts.join(surrogates(parts, secret), ["kind", "entity"])
    found = found.groupBy("mention").agg(F.sort_array(F.collect_list(F.struct("at", "surrogate"))).alias("found"))
    rows = kinds.join(found, "mention")
    return rows.select("mention", _rendered(F.col("kind"), F.col("mention"), F.col("found.surrogate")).alias("replacement"))


def replace(docs: DataFrame, secret: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with each mention of personal data in ``text`` replaced by its surrogate.

    An entity has one surrogate in the whole corpus, however it is written, so mentions that
    belonged together still do, and no two entities share one. Kind, format, script, case and a
    title's gender are kept; card and account numbers stay valid ones. A name is found by its title,
    then each of its words wherever it stands in the same text, but for words as common as "Will". Texts are cut at their
    mentions and joined again, so a surrogate is never searched in turn. Most texts mention
    nobody and take no part in any shuffle; equal texts are looked up once. NULL and empty texts
    stay as they are, as do repeated rows and other columns, whatever they are called; an empty table
    gives no row.
    ``count``: a column to add, the number of mentions replaced.
    """
    body, names = F.col(f"`{text}`"), [f"`{c}`" for c in docs.columns]
    own_id, own_find, own_map = unused(docs, "_pii_id", "_pii_find", "_pii_map")
    has = F.coalesce(body.rlike(HINT) & body.rlike(MENTION), F.lit(False))
    hit = docs.where(has).withColumn(own_id, F.sha2(body, 256)).withColumn(own_find, _finder(body))
    find, known = F.col(own_find), F.col(own_map)
    seen = hit.select(F.col(own_id).alias("id"), F.explode(F.regexp_extract_all(body, find, F.lit(0))).alias("mention"))
    seen = reliable(seen.distinct())
    pairs = seen.join(replacements(seen, secret), "mention")
    lookup = pairs.groupBy(F.col("id").alias(own_id)).agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "replacement"))).alias(own_map)
    )
    rows = hit.join(lookup, own_id, "left")
    gaps, found = F.split(body, find, -1), F.regexp_extract_all(body, find, F.lit(0))
    new = F.transform(found, lambda m: F.coalesce(known[m], m))
    joined = F.array_join(F.zip_with(gaps, new, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    n = F.size(F.filter(found, lambda m: known[m].isNotNull()))
    changed = F.when(known.isNull(), body).otherwise(joined)
    number = F.when(known.isNull(), 0).otherwise(n)
    shown = [changed.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    rest = docs.where(~has).select(*names)
    if count:
        return rows.select(*shown, number.alias(count)).union(rest.select("*", F.lit(0).alias(count)))
    return rows.select(*shown).union(rest)

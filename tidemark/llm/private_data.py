"""Personal data replaced by surrogates, with DataFrame functions only.

Every mention is taken apart into entities (an address, its domain, a number, a first
name, a surname). Each distinct entity of the corpus gets one surrogate: a keyed hash
of its type and normal form, written in the same alphabet, case and length, names in
the same script and gender. So the same entity has the same surrogate wherever and
however it is written. Surrogates that collide with each other or with a real entity
are drawn again until all are distinct; from the attempt ``WIDER`` on surrogates of every
type grow with each attempt, so that there is always a free one. Mentions are then rewritten in their own format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Don Господин Κύριος".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Sra Doña Госпожа Κυρία".split(),
    "x": "Dr Prof".split(),
}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
#: Name beginnings and endings by script; an ending tells the gender.
SYLLABLES = {
    "latin": ("bal cor dan fel gar hal ivo jon kar lin mar nor oli per ros sam tor ula vel wil".split(), {"m": "us an ord ik".split(), "f": "a ina ette ea".split(), "x": "is en el ar".split()}),
    "cyrillic": ("бор вал гал дан ева зор иль кар лад мир нов ост пав род сам тим уль фад хар яр".split(), {"m": "ан ей ик ор".split(), "f": "а ина ия ея".split(), "x": "ий ен ис ель".split()}),
    "greek": ("αλκ βασ γαλ δαν ελπ ζην θαλ ιων καρ λαμ μελ νικ ολυ περ ροδ σαμ τιμ υλα φαν χαρ".split(), {"m": "ος ης ων ας".split(), "f": "α η ια ινα".split(), "x": "ις αξ ηρ υς".split()}),
}

#: The first attempt in which surrogates are longer than what they stand for.
WIDER = 6
_TITLE = "|".join(t for names in TITLES.values() for t in names)
#: A word of a name, and what may stand between two of them. Repetitions are possessive and words have a left
#: edge, so that no pattern goes back over long words or long rows of names: time and stack are bounded.
NAME_WORD = r"\p{Lu}(?:\p{L}++(?:['-]\p{L}{2,}+)*+|(?:['-]\p{L}{2,}+)++)"
_PARTICLE = "von|van|vom|zu|zur|zum|der|den|de|del|della|di|da|do|dos|das|du|la|le|ten|ter|el|al|bin|ibn|y|e"
#: The words of a name in a text without titles, at word edges.
ALONE = rf"(?<![\p{{L}}\p{{N}}_]){NAME_WORD}"
#: Kinds of mentions in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?\"?[A-Za-z0-9+/_\-]{8,}|\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,}|\bsk-[A-Za-z0-9_-]{20,}",
    "name": rf"\b(?:{_TITLE})\.?(?:\x20(?:{_PARTICLE})(?=\x20))*+\x20{NAME_WORD}(?:(?:\x20(?:(?:{_PARTICLE})(?=\x20)|\p{{Lu}}\.))*+\x20{NAME_WORD})*+",
    "iban": r"\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\w.])\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)[\x20.-]?)?\d{2,4}(?:[\x20.-]?\d{2,4}){1,4}\b|(?<![\w.])\(\d{3}\)\x20?\d{3}-\d{4}\b|\b\d{3}[-.]\d{3}[-.]\d{4}\b"
    # national forms: 030 1234567, 0171/123 4567, (030) 1234567, 01 23 45 67 89, 988 555 2485
    r"|(?<![\w.+/-])(?=0(?:[\x20/-]?\d){8})0\d{1,4}[\x20/-]\d{3,8}(?:[\x20-]\d{2,4}){0,3}\b|\(0\d{1,4}\)\x20?\d{3,8}(?:[\x20-]\d{2,4}){0,3}\b|(?<![\w.+-])0\d(?:[\x20.]\d{2}){4}\b|(?<![\w.+-])[2-9]\d{2}\x20[2-9]\d{2}\x20\d{4}\b",
    "card": r"(?<![\w.+-])[3-6]\d{3}(?:[\x20-]?\d){8,14}\d\b(?![.-]\d)",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "ipv6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*\d)[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![\w:])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b(?!\.\d)",
}
#: What stays of a secret's mention.
SECRET_START = r"(?:(?i:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?\"?|AKIA|gh[pousr]_|sk-)?"
MENTION = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kind(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(mention.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _entity(type_: Column | str, value: Column) -> Column:
    return F.struct((F.lit(type_) if isinstance(type_, str) else type_).alias("type"), value.alias("value"))


def _entities(kind: Column, mention: Column) -> Column:
    """The entities of a mention, in the order in which they stand in it: type and normal form."""
    words = F.split(mention, r"\x20", -1)
    title = F.regexp_extract(mention, r"^\p{L}+", 0)  # of the mention, not of its words: this is worked out for each word
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("x")
    named = F.filter(F.slice(words, F.lit(2), F.size(words)), lambda w: w.rlike(f"^{NAME_WORD}$"))
    last = F.element_at(named, -1)
    firsts = F.transform(F.slice(named, 1, F.greatest(F.size(named) - 1, F.lit(0))), lambda w: _entity(F.concat(F.lit("first-"), gender, F.lit("-"), _script(w)), F.lower(w)))
    surname = _entity(F.concat(F.lit("surname-"), _script(last)), F.lower(last))
    digits = F.regexp_replace(mention, r"\D", "")
    halves = F.split(F.lower(mention), "::", -1)
    groups = [F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "") for i in (0, 1)]
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(groups[0]) - F.size(groups[1]), F.lit(0)))
    ipv6 = F.array_join(F.transform(F.concat(groups[0], zeros, groups[1]), lambda g: F.lpad(g, 4, "0")), ":")
    code = F.regexp_extract(mention, rf"^{SECRET_START}(.*)$", 1)
    return (
        F.when(kind == "email", F.array(_entity("email", F.lower(mention)), _entity("domain", F.lower(F.substring_index(mention, "@", -1)))))
        .when(kind == "name", F.concat(firsts, F.array(surname)))
        .when(kind == "secret", F.array(_entity("secret", code)))
        .when(kind == "iban", F.array(_entity("iban", F.regexp_replace(mention, r"\x20", ""))))
        .when(kind == "ip", F.array(_entity("ip", mention)))
        .when(kind == "ipv6", F.array(_entity("ipv6", ipv6)))
        .otherwise(F.array(_entity(kind, digits)))
    )


def _stream(seed: Column):
    """Number ``i`` (from 0) of a seed's stream: a function of i."""

    def number(i: Column) -> Column:
        return F.pmod(F.xxhash64(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256)), F.lit(1 << 40))

    return number


def _pick(choices: Column, number: Column) -> Column:
    return F.element_at(choices, (F.pmod(number, F.size(choices)) + 1).cast("int"))


def _letters(value: Column, number) -> Column:
    """``value`` with each letter and digit changed for another of its alphabet and case; hexadecimal stays so."""

    def drawn(alphabet, i: Column) -> Column:
        alphabet = alphabet if isinstance(alphabet, Column) else F.lit(alphabet)
        return _pick(F.split(alphabet, ""), number(i))

    def change(alike: Column, c: Column, i: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), F.pmod(number(i), F.lit(10)).cast("string")).when(c.rlike("[a-z]"), drawn(alike, i)).when(c.rlike("[A-Z]"), F.upper(drawn(ALPHABETS["latin"], i)))
        for script in ("cyrillic", "greek"):
            letter = F.when(c == F.upper(c), F.upper(drawn(ALPHABETS[script], i))).otherwise(drawn(ALPHABETS[script], i))
            out = out.when(c.rlike(rf"\p{{Is{script.capitalize()}}}"), letter)
        return out.when(c.rlike(r"\p{L}"), drawn(ALPHABETS["latin"], i)).otherwise(c)

    # value and alphabet are bound once, not worked out for each character
    def changed(given: Column) -> Column:
        return F.array_join(F.transform(F.split(given["value"], ""), lambda c, i: change(given["alike"], c, i)), "")

    alike = F.when(value.rlike("^[0-9a-f]*$"), "abcdef").otherwise(ALPHABETS["latin"])
    return F.transform(F.array(F.struct(value.alias("value"), alike.alias("alike"))), changed)[0]


def _luhn(digits: Column) -> Column:
    """The sum that a valid card number has divisible by 10."""

    def term(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), term), F.lit(0), lambda s, v: s + v)


def _card(value: Column, plain: Column) -> Column:
    """Digits with the first one kept and the last one set so that the check holds if it holds for ``value``."""
    body = F.concat(F.substring(value, 1, 1), F.substring(plain, F.lit(2), F.length(plain)))

    def settle(x: Column) -> Column:
        front = F.substring(x, F.lit(1), F.length(x) - 1)
        right = F.pmod(F.lit(10) - F.pmod(_luhn(F.concat(front, F.lit("0"))), F.lit(10)), F.lit(10))
        given = F.pmod(F.substring(x, -1, 1).cast("int"), F.lit(9))
        wrong = F.when(given >= right, given + 1).otherwise(given)
        return F.concat(front, F.when(_luhn(value) % 10 == 0, right).otherwise(wrong).cast("string"))

    return F.transform(F.array(body), settle)[0]


def _name(type_: Column, number, attempt: Column) -> Column:
    script = F.substring_index(type_, "-", -1)

    def by_script(choose) -> Column:
        out = choose("latin")
        for s in ("cyrillic", "greek"):
            out = F.when(script == s, choose(s)).otherwise(out)
        return out

    def ending(s: str) -> Column:
        of = {g: F.array(*map(F.lit, e)) for g, e in SYLLABLES[s][1].items()}
        return F.when(type_.startswith("first-m"), of["m"]).when(type_.startswith("first-f"), of["f"]).otherwise(of["x"])

    # each further attempt makes a name longer, so that there is always a free one
    length = F.when(type_.startswith("surname"), 2).otherwise(1) + attempt
    begin = F.transform(F.sequence(F.lit(1), length), lambda i: _pick(by_script(lambda s: F.array(*map(F.lit, SYLLABLES[s][0]))), number(i)))
    return F.concat(F.array_join(begin, ""), _pick(by_script(ending), number(F.lit(0))))


def _surrogate(type_: Column, value: Column, attempt: Column, key: str) -> Column:
    # the seed is bound once: a long value is hashed once and not for each of its characters
    seed = F.sha2(F.concat_ws("|", F.lit(key), attempt.cast("string"), type_, value), 256)
    return F.transform(F.array(seed), lambda s: _drawn(type_, value, attempt, _stream(s)))[0]


def _drawn(type_: Column, value: Column, attempt: Column, number) -> Column:
    domain = F.substring_index(value, "@", -1)
    country = F.greatest(F.length(value) - 10, F.lit(0))
    # letters or digits behind the draw, one more with each attempt
    longer = F.sequence(F.lit(1), F.greatest(attempt - WIDER + 1, F.lit(0)))
    longer = F.when(attempt < WIDER, F.array().cast("array<int>")).otherwise(longer)
    letters = F.array_join(F.transform(longer, lambda i: _pick(F.split(F.lit(ALPHABETS["latin"]), ""), number(i + 1000))), "")
    digits = F.array_join(F.transform(longer, lambda i: F.pmod(number(i + 1000), F.lit(10)).cast("string")), "")
    plain = F.concat(_letters(value, number), digits)
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (F.pmod(number(i), F.lit(254)) + 1).cast("string"))
    return (
        F.when(type_ == "email", F.concat(_letters(F.substring_index(value, "@", 1), number), letters, F.lit("@"), domain))
        .when(type_ == "domain", F.concat(_letters(F.regexp_replace(value, r"\.[^.]*$", ""), number), letters, F.lit("."), F.substring_index(value, ".", -1)))
        .when(type_ == "ip", F.concat_ws(".", octets, F.transform(longer, lambda i: F.pmod(number(i + 1000), F.lit(254)).cast("string"))))
        .when(type_ == "ipv6", F.concat_ws(":", F.lit("2001"), F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: F.lpad(F.lower(F.hex(F.pmod(number(i), F.lit(65536)))), 4, "0"))))
        .when(type_ == "card", _card(value, plain))
        .when(type_ == "phone", F.concat(F.substring(value, F.lit(1), country), F.substring(plain, country + 1, F.length(plain))))
        .when(type_ == "iban", F.concat(F.substring(value, 1, 2), F.substring(plain, F.lit(3), F.length(plain))))
        .when(type_.startswith("first") | type_.startswith("surname"), _name(type_, number, attempt))
        .otherwise(plain)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``type``, ``value`` and ``surrogate`` for each distinct entity (``type``, ``value``).

    Of entities that draw the same surrogate the first by value keeps it, the others
    draw again, and so do those whose surrogate is a real entity. From the attempt ``WIDER``
    on each draw is longer than the one before (in an IP address by a number), so this ends.
    """
    entities = stored(entities.select("type", "value").distinct(), "entities")
    real = entities.select("type", F.col("value").alias("surrogate"))
    settled, open_ = None, entities.withColumn("attempt", F.lit(0))
    rank = Window.partitionBy("type", "surrogate").orderBy("attempt", "value")
    while True:
        drawn = open_.withColumn("surrogate", _surrogate(F.col("type"), F.col("value"), F.col("attempt"), key))
        drawn = drawn.join(real.withColumn("real", F.lit(True)), ["type", "surrogate"], "left")
        both = drawn.select("type", "value", "attempt", "surrogate", "real")
        if settled is not None:  # what is settled stays first
            both = both.union(settled.select("type", "value", F.lit(-1), "surrogate", F.lit(None).cast("boolean")))
        both = stored(both.withColumn("good", (F.row_number().over(rank) == 1) & F.col("real").isNull()), "surrogates")
        settled = both.filter("good").select("type", "value", "surrogate")
        open_ = both.filter("not good").select("type", "value", (F.col("attempt") + 1).alias("attempt"))
        if open_.isEmpty():
            return settled


def cased(name: Column, like: Column) -> Column:
    return F.when(like == F.upper(like), F.upper(name)).otherwise(F.initcap(name))


def _written(kind: Column, mention: Column, parts: Column) -> Column:
    """The surrogates of a mention's entities in the format of the mention."""
    first = parts[0]
    words = F.split(mention, r"\x20", -1)

    name = F.aggregate(
        F.slice(words, F.lit(2), F.size(words)),
        F.struct(words[0].alias("out"), F.lit(1).alias("at")),
        lambda s, w: F.when(
            w.rlike(f"^{NAME_WORD}$"), F.struct(F.concat_ws(" ", s["out"], cased(F.get(parts, s["at"] - 1), w)).alias("out"), (s["at"] + 1).alias("at"))
        ).otherwise(F.struct(F.concat_ws(" ", s["out"], w).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )
    email = F.concat(F.substring_index(first, "@", 1), F.lit("@"), parts[1])
    slots = F.aggregate(
        F.split(mention, ""),
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike("[A-Za-z0-9]"), F.struct(F.concat(s["out"], F.substring(first, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: F.concat(s["out"], F.substring(first, s["at"], F.length(first))),  # what a longer surrogate has more stands last
    )
    return (
        F.when(kind == "email", F.when(mention == F.upper(mention), F.upper(email)).otherwise(email))
        .when(kind == "name", name)
        .when(kind == "secret", F.concat(F.regexp_extract(mention, rf"^{SECRET_START}", 0), first))
        .when(kind.isin("ip", "ipv6"), first)
        .otherwise(slots)
    )


def replace_private(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows and columns with surrogates in the text, and ``n_replaced``.

    ``key`` decides the surrogates; without it they cannot be told from the text. Null
    texts stay null and empty ones empty. Rows that repeat an id and its text get the
    same result. A column of the input that is called n_replaced gives way.
    """
    docs = docs.select(*[c for c in docs.columns if c != "n_replaced"])
    columns = docs.columns
    # the patterns go over all texts once; what they found travels with the text
    searched = stored(docs.withColumn("__found", F.regexp_extract_all(F.col(text_col), F.lit(MENTION), F.lit(0))), "searched")
    found = F.coalesce(F.size("__found"), F.lit(0)) > 0
    hit = searched.filter(found)
    mentions = (
        hit.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"), F.posexplode("__found").alias("pos", "mention"))
        .withColumn("kind", _kind(F.col("mention")))
        .withColumn("entities", _entities(F.col("kind"), F.col("mention")))
    )
    mentions = stored(mentions, "mentions")
    single = mentions.select("i", "h", "pos", "kind", "mention", F.posexplode("entities").alias("part", "entity")).select("i", "h", "pos", "kind", "mention", "part", "entity.type", "entity.value")
    names = surrogates(single, key)
    rewritten = (
        single.join(names, ["type", "value"])
        .groupBy("i", "h", "pos", "kind", "mention")
        .agg(F.array_sort(F.collect_set(F.struct("part", "surrogate"))).alias("parts"))
        # the list of surrogates is bound once, not worked out for each word of a mention
        .withColumn("new", F.transform(F.array(F.col("parts.surrogate")), lambda own: _written(F.col("kind"), F.col("mention"), own))[0])
        .groupBy("i", "h")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda p: p["new"]).alias("__new"))
    )
    # the names found behind titles, wherever else they stand in their document; a surname before a first name
    known = (
        single.filter("kind = 'name'").join(names, ["type", "value"]).groupBy("i", "h", "value").agg(F.max_by("surrogate", "type").alias("surrogate"))
        .groupBy("i", "h").agg(F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("__names"))
    )
    rewritten = rewritten.join(known.select(F.col("i").alias("ki"), F.col("h").alias("kh"), "__names"), F.col("i").eqNullSafe(F.col("ki")) & (F.col("h") == F.col("kh")), "left").select("i", "h", "__new", "__names")

    def renamed(segment: Column) -> Column:
        words = F.transform(F.regexp_extract_all(segment, F.lit(ALONE), F.lit(0)), lambda w: F.coalesce(cased(F.try_element_at(F.col("__names"), F.lower(w)), w), w))
        return F.when(F.col("__names").isNull(), segment).otherwise(F.array_join(F.zip_with(F.split(segment, ALONE, -1), words, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))

    def later(segment: Column) -> Column:
        return F.size(F.filter(F.regexp_extract_all(segment, F.lit(ALONE), F.lit(0)), lambda w: F.try_element_at(F.col("__names"), F.lower(w)).isNotNull()))

    plain = F.split(F.col(text_col), MENTION, -1)
    between = F.transform(plain, renamed)
    more = F.when(F.col("__names").isNull(), 0).otherwise(F.aggregate(plain, F.lit(0), lambda n, x: n + later(x)))
    text = F.array_join(F.zip_with(between, "__new", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = hit.join(rewritten, F.col(id_col).eqNullSafe(F.col("i")) & (F.xxhash64(text_col) == F.col("h")))
    changed = changed.withColumn("n_replaced", (F.size("__new") + more).cast("long")).withColumn(text_col, text).select(*columns, "n_replaced")
    return changed.union(searched.filter(~found).select(*columns, F.lit(0).cast("long").alias("n_replaced")))


def op3_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    replaced = replace_private(table(spark, sf_dir, "documents"), key="tidemark")
    return replaced.select("doc_id", "text", "n_replaced")

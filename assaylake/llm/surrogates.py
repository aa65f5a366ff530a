"""Personal data and secrets replaced by surrogates: keyed, of the same type and format, distinct, the same everywhere.

Entities are found by patterns, brought to a normal form (an address in lower case, a number as its digits, a name word by
word), and every distinct one gets a surrogate drawn from a keyed digest. Two entities that would share a surrogate, or a
surrogate that is someone's real value, are drawn again. All mentions of an entity, however they are written, get the
same surrogate in their own writing. All of it is DataFrame operations; only rows with entities are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.rows import unwrap, wrap
from assaylake.llm.spot_signatures import anchors
from assaylake.session import settle

#: Draws in the entity's own form. What still collides then, because its form has too few values for all that have it,
#: gets a tag of its kind with 64 bits of the digest instead.
DRAWS = 12

#: Titles before names, also several of them, as in "Frau Dr. Schmidt".
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mademoiselle", "Mme", "Mlle", "Señora", "Señorita", "Doña", "Sra", "Srta", "Dra", "Г-жа", "Κα")
OTHER = ("Mr", "Mx", "Sir", "Lord", "Herrn", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κος", "Dr", "Doctor", "Docteur", "Doktor", "Prof", "Professor", "Professeur", "Д-р")
TITLE = rf"(?:{'|'.join((*FEMALE, *OTHER))})\.? "
TITLES = rf"(?:{TITLE}){{1,4}}"
#: What numbers of a phone do not begin with: a date, or two years.
NO_DATE = (
    r"(?!(?:19|20)[0-9]{2}[ ./-](?:(?:19|20)[0-9]{2}|[01]?[0-9][ ./-][0-3]?[0-9])(?![0-9]))"
    r"(?![0-3]?[0-9][ ./-][0-3]?[0-9][ ./-](?:19|20)[0-9]{2}(?![0-9]))"
)
#: Seven to fifteen digits, whatever stands between them, where a phone is to begin.
DIGITS = r"(?=\(?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}(?![0-9]))"

#: Patterns by type, in order of precedence. Each starts where no character before it could belong to it, so that no run
#: of characters is searched twice.
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}+",
    "aws_key": r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "password": r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api[_-]?key)(?-i)\s{0,2}[=:]\s{0,2}[\"']?[^\s\"']{6,}+",
    "hex_secret": r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv4": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    # in order: three groups after an area code in brackets or without a leading 0; international; national with a leading
    # 0; groups of two to four digits; three groups
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[1-9][0-9]{1,3}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    rf"|(?<![0-9A-Za-z])\+{DIGITS}[0-9]{{1,4}}(?:[ ()./-]{{0,3}}[0-9]{{1,8}}){{1,6}}(?![0-9])"
    rf"|(?<![0-9A-Za-z+])(?<![0-9][./-]){NO_DATE}{DIGITS}(?:\(0[0-9]{{1,5}}\)|0[0-9]{{1,5}})(?:[ ./-]{{1,3}}[0-9]{{2,8}}){{1,5}}(?![0-9])"
    rf"|(?<![0-9A-Za-z+])(?<![0-9][./-]){NO_DATE}{DIGITS}[0-9]{{2,4}}(?:[ ./-][0-9]{{2,4}}){{2,5}}(?![0-9])"
    r"|(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+[0-9]{7,15}(?![0-9])",
    "name": rf"(?<!\p{{L}}){TITLES}\p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity holds at least one of; texts without are not searched further.
HINT = rf"[0-9@]|(?i:password|passwd|pwd|secret|token|api[_-]?key)|{TITLE}\p{{Lu}}|A(?:KIA|SIA)[A-Z0-9]{{16}}|[a-f]{{32}}"
NAMES = ("given_f", "given_m", "surname")
#: Syllables that sixteen hexadecimal digits stand for in made-up names, and endings of given names.
SYLLABLES = ("ba", "de", "fi", "go", "lu", "ma", "ne", "ri", "so", "tu", "va", "ke", "li", "mo", "nu", "ra")
ENDINGS = {"given_f": "na", "given_m": "ton", "surname": "ler"}
#: Letters of the syllables in other scripts.
LATIN, CYRILLIC, GREEK = "abdefgiklmnorstuv", "абдефгиклмнорстув", "αβδεφγικλμνορστυω"


def _type(entity: Column) -> Column:
    return reduce(lambda rest, t: F.when(entity.rlike(f"^(?:{PATTERNS[t]})$"), t).otherwise(rest), reversed(PATTERNS), F.lit("phone"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _value(raw: Column, kind: Column) -> Column:
    """The part of a mention that is replaced: all but the keyword of a password."""
    return F.when(kind == "password", F.regexp_extract(raw, r"[=:]\s{0,2}[\"']?(.*)$", 1)).otherwise(raw)


def _bare(name: Column) -> Column:
    """A name word without the ending of a genitive."""
    return F.regexp_replace(name, "'s?$", "")


def _normal(raw: Column, kind: Column) -> Column:
    digits = _digits(raw)
    return (
        F.when(kind == "email", F.lower(raw))
        .when(kind.isin("ssn", "card"), digits)
        # a national number may come with the country code 1
        .when(kind == "phone", F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits))
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind.isin(*NAMES), F.lower(_bare(raw)))
        .otherwise(raw)
    )


def _stream(key: str, seed: Column, draw: int, blocks: int = 4) -> Column:
    """Hexadecimal digits that only the key's holder can derive; 64 a block, and as many blocks as asked for."""
    return F.concat(*(F.sha2(F.concat(F.lit(f"{key}\0{draw}\0{b}\0"), seed, F.lit(f"\0{key}")), 256) for b in range(blocks)))


def _like(text: Column, stream: Column) -> Column:
    """The text with every ASCII digit and letter exchanged for another of its kind, drawn from the stream."""
    digits, letters = F.translate(stream, "abcdef", "274183"), F.translate(stream, "0123456789abcdef", "qwhzjkmpxrgbtdny")
    at = lambda s, k: F.substring(s, (k % 256 + 1).cast("int"), F.lit(1))
    chars = F.transform(
        F.split(text, ""),
        lambda c, k: F.when(c.rlike("[0-9]"), at(digits, k)).when(c.rlike("[a-z]"), at(letters, k)).when(c.rlike("[A-Z]"), F.upper(at(letters, k))).otherwise(c),
    )
    return F.array_join(chars, "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of a number's digits with every second from the right, but the last, doubled; a multiple of ten if valid."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, k: F.when(k % 2 == 1, F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _card(normal: Column, stream: Column) -> Column:
    """Another number with the same first digit that is valid if the first one is."""
    fresh = F.concat(F.substring(normal, 1, 1), F.substring(_like(normal, stream), F.lit(2), F.length(normal) - 2))
    check = ((10 - _luhn_sum(F.concat(fresh, F.lit("0"))) % 10) % 10).cast("string")
    other = F.substring(_like(normal, stream), -1, 1)
    return F.concat(fresh, F.when(_luhn_sum(normal) % 10 == 0, check).otherwise(other))


def _address(normal: Column, key: str, stream: Column) -> Column:
    """Another mail address; the domain is drawn by itself, so that shared domains stay shared. The ending stays."""
    local, domain = F.substring_index(normal, "@", 1), F.substring_index(normal, "@", -1)
    ending = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(ending) - 1)
    return F.concat(_like(local, stream), F.lit("@"), _like(host, _stream(key, F.concat(F.lit("host:"), domain), 0)), F.lit("."), ending)


def _name(kind: Column, script: Column, stream: Column, draw: int) -> Column:
    """A made-up name in lower case: syllables, one more for every draw, and an ending of its gender or of surnames."""
    parts = [
        F.element_at(F.array(*map(F.lit, SYLLABLES)), F.conv(F.substring(stream, k + 1, 1), 16, 10).cast("int") + 1) for k in range(2 + draw // 2)
    ]
    ending = reduce(lambda rest, e: F.when(kind == e, ENDINGS[e]).otherwise(rest), ENDINGS, F.lit(""))
    latin = F.concat(*parts, ending)
    return F.when(script == "cyrillic", F.translate(latin, LATIN, CYRILLIC)).when(script == "greek", F.translate(latin, LATIN, GREEK)).otherwise(latin)


def _script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _draw(key: str, draw: int) -> Column:
    """The surrogate of a normal form at a draw."""
    kind, normal = F.col("kind"), F.col("normal")
    stream = _stream(key, F.concat(kind, F.lit(":"), normal), draw)
    octet = lambda k: (F.conv(F.substring(stream, 2 * k + 1, 2), 16, 10).cast("int") % 254 + 1).cast("string")
    if draw >= DRAWS:
        return F.concat(kind, F.lit("-"), F.substring(stream, 1, 16))
    return (
        F.when(kind == "email", _address(normal, key, stream))
        .when(kind == "ipv4", F.concat_ws(".", *(octet(k) for k in range(4))))
        .when(kind == "card", _card(normal, stream))
        .when((kind == "hex_secret") | (kind == "password") & normal.rlike("^[0-9a-f]{1,256}$"), F.substring(stream, F.lit(1), F.length(normal)))
        .when(kind == "aws_key", F.concat(F.substring(normal, 1, 4), _like(F.substring(normal, 5, 64), stream)))
        .when(kind == "iban", F.concat(F.substring(normal, 1, 2), _like(F.substring(normal, 3, 64), stream)))
        .when(kind.isin(*NAMES), _name(kind, F.col("script"), stream, draw))
        .otherwise(_like(normal, stream))
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """kind, normal and surrogate of every distinct entity (kind, normal, script).

    Of entities that draw the same surrogate the smallest keeps it, unless it is a real entity's value or already given
    away; the others draw again, until none is left. Draws after the first concern few rows, and each is stored.
    """
    real = settle(entities.select("kind", "normal", "script").distinct(), "entities")
    given, pending, draw = None, real, 0
    while True:
        drawn = pending.withColumn("surrogate", _draw(key, draw))
        best = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("normal", "script")).alias("first"))
        best = best.select("kind", "surrogate", "first.normal", "first.script")
        best = best.join(real.select("kind", F.col("normal").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if given is not None:
            best = best.join(given.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        kept = settle(best, "surrogates")
        given = kept if given is None else given.unionByName(kept)
        pending = settle(pending.join(kept.select("kind", "normal"), ["kind", "normal"], "left_anti"), "redrawn")
        if pending.isEmpty():
            return given.select("kind", "normal", "surrogate")
        draw += 1


def _lay_out(raw: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate written as the mention is: digits go where digits were, from the right; case follows."""
    digits = _digits(raw)
    full = F.concat(F.substring(digits, F.lit(1), F.greatest(F.length(digits) - F.length(surrogate), F.lit(0))), surrogate)
    count = lambda c: F.length(_digits(c))
    filled = F.array_join(
        F.transform(
            F.split(raw, ""),
            lambda c, k: F.when(c.rlike("[0-9]"), F.substring(full, count(F.substring(raw, F.lit(1), k + 1)), F.lit(1))).otherwise(c),
        ),
        "",
    )
    grouped = F.array_join(
        F.transform(
            F.split(raw, ""),
            lambda c, k: F.when(
                c != " ", F.substring(surrogate, F.length(F.regexp_replace(F.substring(raw, F.lit(1), k + 1), " ", "")), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )
    proper = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate)))
    cased = F.when((_bare(raw) == F.upper(_bare(raw))) & (F.length(raw) > 1), F.upper(surrogate)).otherwise(proper)
    return (
        F.when(surrogate.startswith(F.concat(kind, F.lit("-"))), surrogate)
        .when(kind.isin("phone", "ssn", "card"), filled)
        .when(kind == "iban", grouped)
        .when(kind.isin(*NAMES), F.concat(cased, F.regexp_extract(raw, "'s?$", 0)))
        .when(kind == "email", F.when((raw == F.upper(raw)), F.upper(surrogate)).otherwise(surrogate))
        .otherwise(surrogate)
    )


def mentions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row per replaced unit of the texts with entities: row_id, row_digest, place of the entity, unit within it, kind,
    normal form, script and the unit's raw text, with what stays before it. A name is a unit per word, so that a surname
    alone refers to the same person's."""
    found = docs.where(F.col(text).rlike(HINT)).select(
        F.col(key).alias("row_id"), F.xxhash64(text).alias("row_digest"), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)).alias("found")
    )
    found = found.where(F.size("found") > 0).dropDuplicates(["row_id", "row_digest"])
    each = found.select("row_id", "row_digest", F.posexplode("found").alias("place", "entity"))
    each = each.withColumn("type", _type(F.col("entity")))
    value = _value(F.col("entity"), F.col("type"))
    single = F.array(F.struct(F.substring("entity", F.lit(1), F.length("entity") - F.length(value)).alias("before"), value.alias("raw"), F.col("type").alias("kind")))
    titles = F.regexp_extract("entity", f"^{TITLES}", 0)
    female = titles.rlike(rf"(?:^| )(?:{'|'.join(FEMALE)})\.? ")
    words = F.split(F.substring("entity", F.length(titles) + 1, F.length("entity")), " ")
    named = F.transform(
        words,
        lambda w, k: F.struct(
            F.when(k == 0, titles).otherwise(F.lit(" ")).alias("before"),
            w.alias("raw"),
            F.when(k == F.size(words) - 1, "surname").when(female, "given_f").otherwise("given_m").alias("kind"),
        ),
    )
    units = each.select("row_id", "row_digest", "place", F.posexplode(F.when(F.col("type") == "name", named).otherwise(single)).alias("unit", "u"))
    units = units.select("row_id", "row_digest", "place", "unit", "u.before", "u.raw", "u.kind")
    return units.withColumn("normal", _normal(F.col("raw"), F.col("kind"))).withColumn("script", _script(F.col("raw")))


def _untitled(piece: Column, names: Column) -> Column:
    """A piece of text between entities with the names that its row has elsewhere after a title replaced, each as a whole
    word, as it is written there, in capitals or capitalised."""

    def one(done: Column, name: Column) -> Column:
        proper = F.concat(F.upper(F.substring(name["surrogate"], 1, 1)), F.substring(name["surrogate"], F.lit(2), F.length(name["surrogate"])))
        word = lambda w: F.concat(F.lit(r"(?<!\p{L})\Q"), w, F.lit(r"\E(?!\p{L})"))
        for form, new in ((F.upper(name["bare"]), F.upper(name["surrogate"])), (name["bare"], proper), (F.initcap(name["bare"]), proper)):
            done = F.regexp_replace(done, word(form), new)
        return done

    return F.aggregate(names, piece, one)


def replace(docs: DataFrame, key_secret: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(docs in all their columns with surrogates in the text, mentions replaced: row_id, place, kind, surrogate).

    Null and empty texts stay as they are. Rows with null or repeated ids are told apart by their texts' hash; repeated
    rows come out alike. The mentions never hold real values. The key decides all surrogates; keep it secret. Name words
    that stand after a title somewhere in a row are replaced wherever else they stand in it, function words apart; these
    places are not among the mentions.
    """
    units = settle(mentions(docs, key, text), "mentions")
    table = assign(units, key_secret)
    written = units.join(table, ["kind", "normal"]).withColumn("new", F.concat("before", _lay_out(F.col("raw"), F.col("kind"), F.col("surrogate"))))
    bare = _bare(F.col("raw"))
    lasting = F.col("kind").isin(*NAMES) & (F.length(bare) > 1) & ~F.lower(bare).isin(anchors())
    written = written.withColumn("name", F.when(lasting, F.struct(bare.alias("bare"), F.col("surrogate"))))
    written = settle(written.select("row_id", "row_digest", "place", "unit", "kind", "new", "name"), "written")
    entities = written.groupBy("row_id", "row_digest", "place").agg(
        F.array_sort(F.collect_list(F.struct("unit", "new"))).alias("u"), F.collect_set("name").alias("names")
    )
    entities = entities.withColumn("new", F.array_join("u.new", ""))
    rows = entities.groupBy("row_id", "row_digest").agg(
        F.array_sort(F.collect_list(F.struct("place", "new"))).alias("news"), F.flatten(F.collect_list("names")).alias("names")
    )
    # one surrogate for a word that is found in two roles; longer words first, since one may be a part of another
    rows = rows.withColumn("names", F.array_sort(F.array_distinct("names"), lambda a, b: F.when(F.length(a["bare"]) != F.length(b["bare"]), F.length(b["bare"]) - F.length(a["bare"])).when(a < b, -1).when(a > b, 1).otherwise(0)))
    wrapped = wrap(docs, key, text)
    has = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    same = F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.xxhash64("text") == F.col("row_digest"))
    touched = wrapped.where(has).join(rows, same, "left")
    between = F.split("text", ANY, -1)
    between = F.when(F.size("names") > 0, F.transform(between, lambda p: _untitled(p, F.col("names")))).otherwise(between)
    pieces = F.zip_with(between, F.col("news.new"), lambda p, n: F.concat(p, F.coalesce(n, F.lit(""))))
    fresh = F.when(F.col("news").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    touched = touched.select(F.struct(*(fresh.alias(c) if c == text else F.col("whole").getField(c).alias(c) for c in docs.columns)).alias("whole"))
    replaced = unwrap(wrapped.where(~has).select("whole").union(touched))
    return replaced, written.select("row_id", "place", "unit", "kind", F.col("new").alias("surrogate"))

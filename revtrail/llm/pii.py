"""Surrogates for personal data: keyed, type-consistent, distinct, coreferent.

Found are e-mail addresses, phone numbers, payment card numbers, IPv4
addresses, social security numbers, secrets behind a keyword, and persons
named behind a title.  Only DataFrame operations are used.

* Each mention is made of *entities*: a type and a normal form (digits of a
  number, a lower-cased address, each name of a person), so that mentions in
  different formats are one entity and get one surrogate.
* A name is one entity wherever it stands, as a given name or a surname; its
  gender is that of the titles of all its mentions, untold if they differ.
* A surrogate is drawn from a keyed hash of its entity: digits for digits,
  letters for letters, the same country code, first octet, card kind (and
  check digit, if the original's is right); a name is built from syllables
  of the original's script, with an ending of its gender.
* Collision checks: no two entities of a type get one surrogate, and no
  surrogate is an entity that occurs; all names are one type for that.  Those
  that fail draw again with the next attempt number, until none is left.
* The surrogate is written in the mention's own format: separators, case,
  and what stands before a number's last digits or a secret stay.
* Names found behind a title in a text are replaced where they recur in it
  without one, as whole words of the same case.

The same key and the same entities give the same surrogates.  The entity
table is small next to the texts and is joined to the mentions; texts
without anything to find pass by without a shuffle.

Null text stays null.  Copies of a text are rewritten alike, and rows that
repeat are all returned.  A name that no title introduces anywhere in its
text is not found.  n_person counts the mentions behind titles.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: Names and addresses grow with the attempts and never run out; numbers can, then it is an error.
MOST_ATTEMPTS = 64

# Titles by gender (f, m, n: not told).
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Госпожа", "Κυρία"],
          "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"],
          "n": ["Dr", "Prof"]}
# Syllables, and endings by gender, of invented names in each script.
SYLLABLES = {"latin": ["ba", "co", "da", "el", "fi", "ga", "ho", "il", "ka", "lo", "ma", "ne", "or", "pa", "ri", "sa",
                       "ti", "ul", "va", "wi", "za", "bre", "cla", "dor", "fen", "gil", "hal", "jor", "kel", "lin", "mor", "nor"],
             "cyrillic": ["ба", "ве", "га", "до", "жи", "за", "ко", "ла", "ми", "но", "по", "ра", "со", "та", "фе", "хо"],
             "greek": ["βα", "γο", "δε", "ζη", "θα", "κο", "λα", "με", "νι", "πο", "ρα", "σο", "τα", "φι", "χα", "ψε"]}
ENDINGS = {"latin": {"f": "na", "m": "ton", "n": "ley", "s": "man"},
           "cyrillic": {"f": "на", "m": "слав", "n": "ко", "s": "енко"},
           "greek": {"f": "να", "m": "νος", "n": "λη", "s": "ίδης"}}

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"
PHONE = r"(?:\+(?=(?:[ .()-]{0,2}\d){8})\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{2,4}\) ?\d{3,4}[ .-]?\d{3,4}|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
SECRET = r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b\s*[=:]\s*)[\"']?[A-Za-z0-9+/_.-]{8,}[\"']?"
SECRET_VALUE = r"[A-Za-z0-9+/_.-]{8,}[\"']?$"
NAME = r"\p{Lu}[\p{Ll}'-]+"
PERSON = r"(?<![\p{L}])(?:" + "|".join(x for v in TITLES.values() for x in v) + r")\.? " + NAME + r"(?: " + NAME + r"){0,2}"
#: What a name that stands alone has around it: no letter, and no part of a longer name (but a possessive s).
BEFORE_NAME, AFTER_NAME = r"(?<!\p{L})(?<!\p{L}['-])", r"(?!\p{L})(?!-\p{L})(?!'(?!s(?!\p{L}))\p{L})"
KINDS = {"secret": SECRET, "email": EMAIL, "ip": IP, "ssn": SSN, "card": CARD, "phone": PHONE, "person": PERSON}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: What every mention holds; most texts have none of it and are done.
HINT = (r"@|\d{3}|\+\d|\d(?:[ -]?\d){12}|\d\.\d{1,3}\.\d|(?i:passw|pwd|secret|token|api.?key)|(?:"
        + "|".join(x for v in TITLES.values() for x in v) + r")\.? \p{Lu}")


def digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def entities_of(mention: Column, kind: Column) -> Column:
    """The mention's entities: array of (type, value), the value in normal form."""
    one = lambda name, value: F.array(F.struct(F.lit(name).alias("type"), value.alias("value")))
    words = F.split(F.regexp_replace(mention, r"^\S+ ", ""), " ")
    title = F.regexp_extract(mention, r"^([^ .]+)", 1)
    gender = F.when(title.isin(TITLES["f"]), "f").when(title.isin(TITLES["m"]), "m").otherwise("n")
    names = F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, F.lit("surname")).otherwise(F.concat(F.lit("given_"), gender)).alias("type"), w.alias("value")))
    return (F.when(kind == "person", names)
            .when(kind == "email", one("email", F.lower(mention)))
            .when(kind == "secret", one("secret", F.regexp_replace(F.regexp_extract(mention, SECRET_VALUE, 0), "[\"']$", "")))
            .when(kind == "ip", one("ip", mention))
            .when(kind == "phone", one("phone", F.substring(digits(mention), -10, 10)))
            .when(kind == "ssn", one("ssn", digits(mention)))
            .otherwise(one("card", digits(mention))))


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern the whole mention matches."""
    return reduce(lambda found, k: found.when(mention.rlike(f"^(?:{KINDS[k]})$"), k), KINDS, F).otherwise("card")


def drawn(stream: Column, i: Column, most: int) -> Column:
    """Number below ``most`` at place i (from 0) of a hex stream of 128 letters."""
    return F.conv(F.substring(stream, (F.pmod(i * 4, F.lit(124)) + 1).cast("int"), 4), 16, 10).cast("int") % most


def like(value: Column, stream: Column, same: int = 0, hexed: Column | bool = False) -> Column:
    """A string of the same format: digits for digits, letters for letters
    (hex ones where ``hexed``); the first ``same`` stay."""
    letters = F.when(F.lit(hexed) if isinstance(hexed, bool) else hexed, 6).otherwise(26)

    def one(i):
        c = F.substring(value, i, 1)
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), F.pmod(drawn(stream, i, 26 * 6), letters) + 1, 1)
        return (F.when((i <= same) | ~c.rlike("[0-9A-Za-z]"), c).when(c.rlike("[0-9]"), drawn(stream, i, 10).cast("string"))
                .when(c.rlike("[a-z]"), letter).otherwise(F.upper(letter)))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def draw(type_: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of an entity at an attempt."""
    stream = F.sha2(F.concat_ws("\x1f", F.lit(key), type_, value, attempt.cast("string")), 512)
    at = F.locate("@", value)
    domain = F.substring(value, at + 1, 1_000_000)
    domain_stream = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain), 512)
    suffix = F.regexp_extract(domain, r"\.[^.]+$", 0)
    # an address grows by a letter every four attempts, so there is always a free one
    longer = F.concat(F.substring(value, F.lit(1), at - 1), F.repeat(F.lit("a"), F.floor(attempt / 4).cast("int")))
    email = F.concat(like(longer, stream), F.lit("@"),
                     like(F.substring(domain, F.lit(1), F.length(domain) - F.length(suffix)), domain_stream), suffix)
    octet = F.when(attempt < 8, F.regexp_extract(value, r"^\d+", 0)).otherwise(drawn(stream, F.lit(3), 256).cast("string"))
    ip = F.concat(octet, *(x for i in range(3) for x in (F.lit("."), drawn(stream, F.lit(i), 256).cast("string"))))
    card = like(value, stream, same=1)
    body = F.substring(card, F.lit(1), F.length(card) - 1)
    right = F.filter(F.array(*(F.lit(str(i)) for i in range(10))), lambda c: F.call_function("luhn_check", F.concat(body, c)))
    card = F.when(F.call_function("luhn_check", value), F.concat(body, right[0])).otherwise(card)

    def name(script):
        gender = F.when(type_ == "surname", "s").otherwise(F.substring(type_, -1, 1))
        end = reduce(lambda found, g: found.when(gender == g, ENDINGS[script][g]), ENDINGS[script], F)
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        many = len(SYLLABLES[script])
        # one syllable more for every two attempts, so there is always a free name
        length = F.lit(3) + F.floor(attempt / 2).cast("int")
        return F.initcap(F.concat(F.array_join(F.transform(F.sequence(F.lit(1), length), lambda i: F.element_at(syllables, drawn(stream, i, many) + 1)), ""), end))
    person = F.when(value.rlike(r"\p{IsCyrillic}"), name("cyrillic")).when(value.rlike(r"\p{IsGreek}"), name("greek")).otherwise(name("latin"))
    return (F.when(type_ == "email", email).when(type_ == "ip", ip).when(type_ == "card", card)
            .when(type_.isin("phone", "ssn"), like(value, stream))
            .when(type_ == "secret", like(value, stream, hexed=value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"))).otherwise(person))


def is_name(type_: Column) -> Column:
    return (type_ == "surname") | type_.startswith("given_")


def told_apart(entities: DataFrame) -> DataFrame:
    """Distinct (domain, type, value) of entities (type, value): what mustn't
    collide shares a domain, and a name has one type there."""
    typed = entities.distinct().withColumn("domain", F.when(is_name(F.col("type")), "name").otherwise(F.col("type")))
    has = lambda t: F.bool_or(F.col("type") == t)
    given = (F.when(has("given_f") & ~has("given_m"), "given_f").when(has("given_m") & ~has("given_f"), "given_m")
             .when(F.bool_or(F.col("type").startswith("given_")), "given_n").otherwise(F.first("type")))
    return typed.groupBy("domain", "value").agg(given.alias("type")).select("domain", "type", "value")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(domain, value, surrogate) of distinct entities (type, value), without collisions."""
    entities = written(told_apart(entities), "entities")
    real = entities.select("domain", F.col("value").alias("surrogate"))
    todo, done = entities, None
    for attempt in range(MOST_ATTEMPTS):
        tried = todo.withColumn("surrogate", draw(F.col("type"), F.col("value"), F.lit(attempt), key))
        first = tried.groupBy("domain", "surrogate").agg(F.min("value").alias("value"))
        first = first.join(real, ["domain", "surrogate"], "left_anti")
        if done is not None:
            first = first.join(done.select("domain", "surrogate"), ["domain", "surrogate"], "left_anti")
        first = first.select("domain", "value", "surrogate")
        done = written(first if done is None else done.unionByName(first), "surrogates")
        todo = written(entities.join(done, ["domain", "value"], "left_anti"), "colliding")
        if todo.isEmpty():
            return done
    raise ValueError(f"no free surrogates after {MOST_ATTEMPTS} attempts")


def recurring(text: Column, names: Column) -> Column:
    """The text with each of the names (array of name, new) replaced wherever it
    stands as a word; all new names are no names that occur, so the order doesn't matter."""
    word = lambda n: F.concat(F.lit(BEFORE_NAME), n, F.lit(AFTER_NAME))
    return F.aggregate(names, text, lambda t, n: F.when(F.contains(t, n["name"]), F.regexp_replace(t, word(n["name"]), n["new"])).otherwise(t))


def in_format(piece: Column, type_: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention ``piece``."""
    have, new = F.length(digits(piece)), F.length(surrogate)

    def digit(i):
        c = F.substring(piece, i, 1)
        place = F.length(digits(F.substring(piece, F.lit(1), i))) - (have - new)
        return F.when(c.rlike("[0-9]") & (place > 0), F.substring(surrogate, place, 1)).otherwise(c)

    def cased(i):
        c = F.substring(piece, i, 1)
        s = F.substring(surrogate, i, 1)
        return F.when(c.rlike("[A-Z]"), F.upper(s)).otherwise(s)

    return (F.when(type_.isin("card", "phone", "ssn"), F.array_join(F.transform(F.sequence(F.lit(1), F.length(piece)), digit), ""))
            .when(type_ == "email", F.array_join(F.transform(F.sequence(F.lit(1), new), cased), ""))
            .when(type_ == "secret", F.replace(piece, value, surrogate)).otherwise(surrogate))


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with surrogates, n_mentions, and n_<kind> of each kind."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hint = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    some = rows.filter(hint).withColumn("copy", F.md5("text"))
    mentions = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    found = some.select("copy", mentions.alias("mentions")).filter(F.size("mentions") > 0).dropDuplicates(["copy"])
    found = found.select("copy", F.posexplode("mentions").alias("place", "mention"))
    found = found.withColumn("kind", kind_of(F.col("mention")))
    found = found.select("copy", "place", "mention", "kind", F.posexplode(entities_of(F.col("mention"), F.col("kind"))).alias("part", "entity"))
    found = written(found.select("copy", "place", "mention", "kind", "part", "entity.type", "entity.value"), "mentions")

    given = surrogates(found.select("type", "value"), key)
    domain = F.when(is_name(F.col("type")), "name").otherwise(F.col("type"))
    parts = found.withColumn("domain", domain).join(given, ["domain", "value"]).drop("domain")
    piece = F.when(F.col("kind") == "person", F.col("value")).otherwise(F.col("mention"))
    parts = parts.withColumn("new", in_format(piece, F.col("type"), F.col("value"), F.col("surrogate")))
    # the names of a mention, the mentions of a text: as many as the text holds
    whole = parts.groupBy("copy", "place", "mention", "kind").agg(F.array_sort(F.collect_list(F.struct("part", "new"))).alias("new"))
    joined = F.array_join(F.transform("new", lambda x: x["new"]), " ")
    whole = whole.withColumn("new", F.when(F.col("kind") == "person", F.concat(F.regexp_extract("mention", r"^\S+ ", 0), joined)).otherwise(joined))
    names = parts.filter(F.col("kind") == "person").groupBy("copy").agg(
        F.array_sort(F.collect_set(F.struct(F.col("value").alias("name"), "new"))).alias("names"))
    by_copy = whole.groupBy("copy").agg(F.array_sort(F.collect_list(F.struct("place", "new", "kind"))).alias("news")).join(names, "copy", "left")

    between = F.split("text", ANY, -1)
    between = F.when(F.col("names").isNull(), between).otherwise(F.transform(between, lambda t: recurring(t, F.col("names"))))
    news = F.concat(F.transform("news", lambda x: x["new"]), F.array(F.lit("")))
    text = F.array_join(F.flatten(F.zip_with(between, news, lambda a, b: F.array(a, b))), "")
    count = lambda k: F.coalesce(F.size(F.filter("news", lambda x: x["kind"] == k)), F.lit(0)).alias(f"n_{k}")
    changed = some.join(by_copy, "copy", "left").select(
        "doc_id", F.when(F.col("news").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.coalesce(F.size("news"), F.lit(0)).alias("n_mentions"), *(count(k) for k in KINDS))
    same = rows.filter(~hint).select("doc_id", "text", F.lit(0).alias("n_mentions"), *(F.lit(0).alias(f"n_{k}") for k in KINDS))
    return changed.unionByName(same)

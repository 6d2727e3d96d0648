"""PII surrogates, in DataFrame functions only.

Entities are found by one pattern: e-mail, IPv4 and IPv6 addresses, IBANs, phone numbers, card
numbers, secrets (by their form, or assigned to a word like password), and names after a title. An
entity's canonical form (lower case for addresses, digits for numbers) is what it is known by, so
that differently written mentions stay the same entity. A name is known by its parts, each with its
role and the gender of the title: so ``Mrs Anna Smith``, ``Ms Smith`` and, further on in the same
document, ``Anna Smith`` or ``Smith`` alone get the same parts. Each distinct entity draws a
surrogate from a keyed hash of (type, canonical form, attempt): digits for digits, letters of the
same case for letters, octets for octets, name parts by gender and script. A surrogate that another
entity drew, or that is an entity itself, is drawn again until all are distinct. Mentions are then
replaced in their own format.

Only texts with entities are joined with surrogates; all others pass through.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.llm.common import cut, unwrapped, wrapped

# Titles by gender.
MALE = "Mr Mister Herr Herrn Monsieur Señor Sr Don господин Господин".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Señora Sra Doña госпожа Госпожа".split()
EITHER = "Dr Prof Doctor Professor".split()

# What a secret of any form is assigned to.
SECRET_WORDS = "password|passwd|pwd|secret|token|api_?key"

PASSWORD = r"[A-Za-z0-9+/_!@#$%^&*?~=.-]{7,}[A-Za-z0-9+/_!@#$%^&*?~=-]"

# The patterns of the entity types, tried in this order.
TYPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
          r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ipv6": r"(?<![0-9A-Fa-f:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|"
            r"(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Fa-f:])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
            r"(?![A-Za-z0-9])",
    "local": r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|"
              r"sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![A-Za-z0-9])",
    "password": r'(?<=[=:" ])(?<=(?i:' + SECRET_WORDS + r') ?[=:] ?"?)' + PASSWORD,
    "name": r"(?<![\p{L}])(?:" + "|".join(MALE + FEMALE + EITHER) +
            r")\.? \p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+){0,2}(?![\p{L}])",
}
ENTITY = "|".join(f"(?:{p})" for p in TYPES.values())
# What any entity has at least one of; texts with none are not searched.
PARTS = ("[0-9@]", "AKIA|gh[pousr]_|sk-", "[a-f]{32}|[A-F]{32}",
         f"(?i:{SECRET_WORDS}) ?[=:]", TYPES["name"])
# Known by their digits.
NUMBERS = ("phone", "local", "card", "ssn")
MOST_DRAWS = 32

# Syllables of invented names, by script.
LATIN = ("al an ar be ca da el en fa ga ha il jo ka la le lo ma mi na no or pe ra ri sa so ta "
         "ti vi").split()
CYRILLIC = ("ал ан ар бе ва да ел ен за га ил ка ла ле ло ма ми на но ор пе ра ри са со та "
            "ти ви").split()


def _keyed(key: str, *parts: Column) -> Column:
    """Hex digits that only the key's owner can draw again."""
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts, F.lit(key)), 256)


def _number(drawn: Column, place: int, below: int) -> Column:
    """A number below ``below`` from four hex digits."""
    return F.pmod(F.conv(F.substring(drawn, 1 + 4 * place, 4), 16, 10).cast("int"), F.lit(below))


def _kind(value: Column) -> Column:
    out = F.lit("name")
    for name in reversed([t for t in TYPES if t != "name"]):
        out = F.when(value.rlike(f"^(?:{_bare(TYPES[name])})$"), name).otherwise(out)
    return out


def _bare(pattern: str) -> str:
    """The pattern without what has to stand around it."""
    pattern = pattern.removeprefix(TYPES["password"].removesuffix(PASSWORD))
    for begin in ("(?<![0-9.])", "(?<![0-9])", "(?<![0-9-])", "(?<![A-Za-z0-9])",
                  "(?<![0-9A-Fa-f:])", "(?<![0-9+(-])"):
        pattern = pattern.removeprefix(begin)
    for end in (r"(?![0-9]|\.[0-9])", "(?![0-9])", "(?![0-9-])", "(?![A-Za-z0-9])",
                "(?![0-9A-Fa-f:])"):
        pattern = pattern.removesuffix(end)
    return pattern


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _canonical(kind: Column, value: Column) -> Column:
    """The canonical forms of a mention: one, or, for a name, gender:role:part of each part."""
    one = (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin(*NUMBERS), _digits(value))
        .when(kind == "ipv6", F.lower(value))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .otherwise(value)
    )
    gender = F.when(value.rlike(_titled(MALE)), "m").when(
        value.rlike(_titled(FEMALE)), "f").otherwise("x")
    parts = F.split(_untitled(value), "[ -]")
    named = F.transform(parts, lambda p, i: F.concat_ws(
        ":", gender, F.when((i == 0) & (F.size(parts) > 1), "given").otherwise("family"), p))
    return F.when(kind == "name", named).otherwise(F.array(one))


def _titled(titles: list[str]) -> str:
    return "^(?:" + "|".join(titles) + r")\.? "


def _untitled(value: Column) -> Column:
    return F.regexp_replace(value, r"^\p{L}+\.? ", "")


def _mapped(text: Column, drawn: Column, alphabet: str, keep: str) -> Column:
    """The text with each character of the alphabet replaced by a drawn one of it, all others
    kept. The n-th character takes the n-th hash digits, continued by hashing again."""
    n = len(alphabet)
    more = F.concat(drawn, *[F.sha2(F.concat(drawn, F.lit(str(i))), 256) for i in range(3)])

    def char(c: Column, i: Column) -> Column:
        at = F.conv(F.substr(more, F.pmod(3 * i, F.lit(254)) + 1, F.lit(3)), 16, 10).cast("int")
        new = F.substr(F.lit(alphabet), F.pmod(at, F.lit(n)) + 1, F.lit(1))
        return F.when(c.rlike(keep), c).otherwise(new)

    return F.array_join(F.transform(F.split(text, ""), char), "")


def _alike(text: Column, drawn: Column) -> Column:
    """Digits for digits and letters of the same case for letters; all else stays."""
    out = text
    for alphabet, keep in (("0123456789", "[^0-9]"), ("abcdefghijklmnopqrstuvwxyz", "[^a-z]"),
                           ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[^A-Z]")):
        out = _mapped(out, drawn, alphabet, keep)
    return out


def _name(drawn: Column, script: list[str], gender: Column, n: int) -> Column:
    parts = [F.element_at(F.array(*map(F.lit, script)),
                          (_number(drawn, i, len(script)) + 1).cast("int")) for i in range(n)]
    ends = ("о", "а") if script is CYRILLIC else ("o", "a")
    return F.initcap(F.concat(*parts, F.when(gender == "f", ends[1]).otherwise(ends[0])))


def _surrogate(kind: Column, canonical: Column, drawn: Column, attempt: int) -> Column:
    """In canonical form. Names grow with the attempts, so that there are enough of them."""
    n = min(3 + attempt // 2, 8)
    digits = "0123456789"
    local = F.concat(
        F.element_at(F.array(*map(F.lit, LATIN)), (_number(drawn, 0, len(LATIN)) + 1).cast("int")),
        F.element_at(F.array(*map(F.lit, LATIN)), (_number(drawn, 1, len(LATIN)) + 1).cast("int")),
        F.lit("."), F.substring(drawn, 30, 6))
    octets = F.concat_ws(".", *[
        (_number(drawn, i, 254) + 1).cast("string") for i in range(4)])
    # Family names have one ending for both genders.
    gender = F.when(canonical.contains(":given:"), F.substring(canonical, 1, 1)).otherwise("m")
    name = F.when(canonical.rlike(r"\p{IsCyrillic}"), _name(drawn, CYRILLIC, gender, n)).otherwise(
        _name(drawn, LATIN, gender, n))
    groups = F.concat_ws(":", *[F.substring(drawn, 1 + 4 * i, 4) for i in range(8)])
    lower, upper = "0123456789abcdef", "0123456789ABCDEF"
    hexa = (
        F.when(canonical.rlike("^[0-9a-f]+$"), _mapped(canonical, drawn, lower, "^$"))
        .when(canonical.rlike("^[0-9A-F]+$"), _mapped(canonical, drawn, upper, "^$"))
        .otherwise(_alike(canonical, drawn))
    )
    prefix = F.regexp_extract(canonical, "^(?:AKIA|gh[pousr]_|sk-)", 0)
    marked = F.concat(prefix, _mapped(F.expr("substr(canonical, length(regexp_extract("
                                             "canonical, '^(?:AKIA|gh[pousr]_|sk-)', 0)) + 1)"),
                                      drawn, "0123456789ABCDEFGHJKLMNPQRSTUVWXYZ", "^$"))
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), _domain(canonical, drawn)))
        .when(kind == "ip", octets)
        .when(kind == "ipv6", groups)
        .when(kind == "iban", F.concat(F.substring(canonical, 1, 2), _alike(
            F.expr("substr(canonical, 3)"), drawn)))
        .when(kind == "phone", F.concat(F.substring(canonical, 1, 1), _mapped(
            F.expr("substr(canonical, 2)"), drawn, digits, "^$")))
        .when(kind.isin("card", "ssn", "local"), _mapped(canonical, drawn, digits, "^$"))
        .when(kind.isin("secret", "password"), F.when(prefix == "", hexa).otherwise(marked))
        .otherwise(name)
    )


def _domain(canonical: Column, drawn: Column) -> Column:
    top = F.substring_index(canonical, ".", -1)
    return F.concat(F.lit("mail"), F.substring(drawn, 40, 3), F.lit(".example."), top)


def _rendered(kind: Column, value: Column, surrogates: Column) -> Column:
    """The surrogates of a mention's canonical forms in its format."""
    one = F.element_at(surrogates, 1)

    def fill(put) -> Column:
        """The mention with its digits, or all but its spaces, from the surrogate."""
        def step(done: Column, c: Column) -> Column:
            return F.struct(
                F.concat(done["text"], F.when(put(c), F.substr(one, done["n"] + 1, F.lit(1)))
                         .otherwise(c)).alias("text"),
                (done["n"] + put(c).cast("int")).alias("n"))

        start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))
        return F.aggregate(F.split(value, ""), start, step, lambda d: d["text"])

    title = F.regexp_extract(value, r"^\p{L}+\.? ", 0)
    joints = F.regexp_extract_all(_untitled(value), F.lit("[ -]"), F.lit(0))
    name = F.array_join(F.transform(surrogates, lambda p, i: F.concat(
        p, F.coalesce(F.get(joints, i), F.lit("")))), "")
    return (
        F.when(kind.isin(*NUMBERS), fill(lambda c: c.rlike("^[0-9]$")))
        .when(kind == "iban", fill(lambda c: c != " "))
        .when(kind == "name", F.concat(title, name))
        .otherwise(one)
    )


def drawn_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate): distinct entities with distinct surrogates, none of which is
    an entity itself. Of entities that draw the same, the least keeps it."""
    real, done = cut(entities.select("kind", "canonical").distinct()), None
    todo = real
    for attempt in range(MOST_DRAWS):
        hashed = _keyed(key, F.col("kind"), F.col("canonical"), F.lit(str(attempt)))
        tried = todo.withColumn("drawn", hashed).select(
            "kind", "canonical",
            _surrogate(F.col("kind"), F.col("canonical"), F.col("drawn"), attempt)
            .alias("surrogate"))
        taken = real.select("kind", F.col("canonical").alias("surrogate"))
        if done is not None:
            taken = taken.union(done.select("kind", "surrogate"))
        first = Window.partitionBy("kind", "surrogate").orderBy("canonical")
        tried = (
            tried.join(taken.distinct().withColumn("taken", F.lit(True)),
                       ["kind", "surrogate"], "left")
            .withColumn("kept", F.col("taken").isNull() & (F.row_number().over(first) == 1))
        )
        tried = cut(tried.select("kind", "canonical", "surrogate", "kept"))
        good = tried.where("kept").drop("kept")
        done = good if done is None else done.union(good)
        todo = tried.where("not kept").select("kind", "canonical")
        if todo.isEmpty():
            return done
    raise ValueError(f"entities without a surrogate of their own after {MOST_DRAWS} draws")


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with replaced mentions, and __entities, the number of them.

    Every other character stays. A null text stays null, and long ones are read whole. Repeated
    rows are replaced alike. Columns keep their order. Should some entities still draw the same
    after MOST_DRAWS attempts, the query fails rather than give two one surrogate.
    """
    columns, docs = docs.columns, wrapped(docs, text_col)
    text = F.col(text_col)
    any_part = reduce(or_, [text.rlike(part) for part in PARTS])
    entities = F.when(any_part, F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    nothing = F.array().cast("array<string>")
    found = docs.withColumn("__found", F.coalesce(entities, nothing))
    none = found.where(F.size("__found") == 0)
    some = cut(found.where(F.size("__found") > 0).withColumn("__row", F.xxhash64(text, "__found")))
    kind, value = _kind(F.col("value")), F.col("value")
    mentions = (
        some.select("__row", F.explode(F.array_distinct("__found")).alias("value")).distinct()
        .withColumn("kind", kind).withColumn("forms", _canonical(F.col("kind"), value))
    )
    forms = mentions.select("__row", "value", "kind",
                            F.posexplode("forms").alias("place", "canonical"))
    surrogates = drawn_surrogates(forms, key)
    both = forms.join(surrogates, ["kind", "canonical"])
    of_value = both.groupBy("__row", "value", "kind").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "surrogate"))), lambda x: x["surrogate"]
    ).alias("surrogates")).withColumn("new", _rendered(F.col("kind"), value, F.col("surrogates")))
    given = of_value.groupBy("__row").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "new"))).alias("__new"))
    # What a name's parts become wherever else they stand in the document; of two persons with
    # one name, the first in order.
    part = F.substring_index("canonical", ":", -1)
    names = both.where("kind = 'name'").groupBy("__row", part.alias("old")).agg(
        F.min_by("surrogate", "canonical").alias("new")).groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("old", "new"))).alias("__names"))
    pieces = F.split(text, ENTITY, -1)

    def renamed(piece: Column) -> Column:
        return F.reduce(F.coalesce("__names", F.array().cast(
            "array<struct<old:string,new:string>>")), piece, lambda t, n: F.regexp_replace(
            t, F.concat(F.lit(r"(?<!\p{L})"), n["old"], F.lit(r"(?!\p{L})")), n["new"]))

    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(
        renamed(p), F.coalesce(F.element_at("__new", F.get("__found", i)), F.lit("")))), "")
    replaced = some.join(given, "__row").join(names, "__row", "left").withColumn("__text", joined)
    out = none.select(text_col, "__rest", F.lit(0).cast("long").alias("__entities")).union(
        replaced.select(F.col("__text").alias(text_col), "__rest",
                        F.size("__found").cast("long").alias("__entities")))
    return unwrapped(out, columns, "__entities")

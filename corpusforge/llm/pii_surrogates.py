"""Personal data and secrets replaced by keyed surrogates, in SQL functions only.

A value is found by pattern, brought to a canonical form (digits of a number,
lower case of an address, the parts of a name), and the canonical form gets a
surrogate of the same kind from a keyed hash: the same value gets the same
surrogate everywhere, however it is written. Surrogates that another value has
already, or that occur as a real value, are drawn again until none is left.
Each mention is then written in its own format: separators, letter case,
country code, a valid check digit where there was one, the gender of the title
and the script of the name.

The texts themselves are shuffled only where they hold something to replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusforge.llm.common import require, temporary, written

_MALE = "Mr Monsieur Herr Señor Sr Господин Κύριος".split()
_FEMALE = "Mrs Ms Miss Madame Mme Mademoiselle Mlle Frau Señora Sra Госпожа Κυρία".split()
_OPEN = "Dr Prof".split()
_TITLES = "|".join(sorted(_MALE + _FEMALE + _OPEN, key=len, reverse=True))
_NAME = r"\p{Lu}[\p{L}'’-]+"
#: Kinds in the order in which a value that fits several is taken.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "card": r"(?<![\d.])\d(?:[ -]?\d){12,18}(?!\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": (r"(?i:(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"
               r"[\p{L}\p{N}+/_.-]{8,}|(?<![\p{L}\p{N}])AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])"
               r"|(?<![\p{L}\p{N}])(?:gh[pousr]_|sk-)[\p{L}\p{N}_-]{16,}|(?<![\p{L}\p{N}])[0-9a-fA-F]{32,}(?![\p{L}\p{N}])"),
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.?[  ]{_NAME}(?:[  ]{_NAME}){{0,2}}",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every value above holds: texts without it are not searched.
_SIGN = rf"[0-9@]|(?i:token|secret|passw|pwd|key|gh[pousr]_|sk-)|(?:{_TITLES})"
_LEAD = r"^(?i:(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)"

#: Syllables and endings that names are made of, by script; the endings by gender.
_SCRIPTS = {
    "latin": ("b d f g l m n r s t v k".split(), "a e i o u".split(), "el on as is".split(), "o us an or".split(),
              "a ia ine ette".split()),
    "cyrillic": ("б д ф г л м н р с т в к".split(), "а е и о у".split(), "ен ов ин ук".split(), "ий ор ан ей".split(),
                 "а ия ина ья".split()),
    "greek": ("β δ φ γ λ μ ν ρ σ τ π κ".split(), "α ε ι ο η".split(), "ας ης ου ακης".split(), "ος ων ης ας".split(),
              "α η ια ω".split()),
}
#: Draws after which values that still clash get each other's place: by then a
#: shape has hardly any value left that no document holds.
DRAWS = 40


def _fold_script(c: Column) -> Column:
    return F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _kind(value: Column) -> Column:
    kind = F.lit("name")
    for name in reversed([k for k in PATTERNS if k != "name"]):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    return kind


def find(text: Column) -> Column:
    """All values of a text, in order, names mentioned again without their title too."""
    first = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    return F.when(text.rlike(_SIGN), first).otherwise(F.array().cast("array<string>"))


def _name_parts(values: Column) -> Column:
    titled = F.filter(values, lambda v: v.rlike(rf"^(?:{_TITLES})\.?[  ]"))
    words = F.flatten(F.transform(titled, lambda v: F.slice(F.split(v, r"[  ]"), 2, 3)))
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 3))


def _pattern(values: Column) -> Column:
    """The pattern for a text: with the names found there, also without title."""
    parts = _name_parts(values)
    # The parts hold letters, ' and - only: nothing to escape.
    bare = F.concat(F.lit(_ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(parts, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    return F.when(F.size(parts) > 0, bare).otherwise(_ANY)


# Drawing surrogates

def _digest(key: str, kind: Column, value: Column, draw: int, more: str = "") -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, value, F.lit(f"{draw}{more}")), 512)


def _number(digest: Column, at: Column | int, below: int) -> Column:
    at = F.lit(at) if isinstance(at, int) else at
    return (F.conv(F.substring(digest, at * 4 + 1, F.lit(4)), 16, 10).cast("int") % below)


def _pick(digest: Column, at: int, items: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), _number(digest, at, len(items)) + 1)


def _same_shape(value: Column, digest: Column) -> Column:
    """Digits by digits, hexadecimal by hexadecimal, letters by letters of their case."""
    hexadecimal = value.rlike("^[0-9a-f]+$|^[0-9A-F]+$")

    def sign(c: Column, i: Column) -> Column:
        n = _number(digest, i % 32, 1 << 16)
        n = n + i * 7  # beyond 32 places the digest repeats
        low = F.when(hexadecimal, F.substring(F.lit("abcdef"), n % 6 + 1, F.lit(1))).otherwise(F.char(n % 26 + 97))
        cyrillic = F.substring(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), n % 27 + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), (n % 10).cast("string")).when(c.rlike("[a-z]"), low)
                .when(c.rlike("[A-Z]"), F.upper(low)).when(c.rlike(r"\p{Ll}"), cyrillic)
                .when(c.rlike(r"\p{Lu}"), F.upper(cyrillic)).otherwise(c))

    return F.array_join(F.transform(F.split(value, ""), sign), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one is the check digit."""
    signs = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    weighed = F.transform(signs, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(weighed, F.lit(0), lambda a, c: a + c)


def _draw(key: str, draw: int) -> Column:
    """A surrogate for the canonical `value` of `kind` in `script`."""
    kind, value = F.col("kind"), F.col("value")
    digest = _digest(key, kind, value, draw)
    shaped = _same_shape(value, digest)
    card = F.concat(F.substring(value, 1, 1), F.substring(shaped, F.lit(2), F.length(value) - 2))
    check = (10 - _luhn_sum(F.concat(card, F.lit("0"))) % 10) % 10
    valid = F.when(_luhn_sum(value) % 10 == 0, check.cast("string")).otherwise(F.substring(shaped, -1, 1))
    # Each tenth draw makes the part before the sign a letter longer.
    local = F.concat(F.substring_index(shaped, "@", 1), *[F.char(_number(digest, 20 + i, 26) + 97) for i in range(draw // 10)])
    address = F.concat_ws("@", local, F.concat_ws(
        ".", F.regexp_replace(F.substring_index(shaped, "@", -1), r"\.[^.]*$", ""), F.substring_index(value, ".", -1)))
    first = F.substring_index(value, ".", 1)
    private = F.regexp_extract(value, r"^(?:10\.|192\.168\.|127\.)", 0)
    octets = [(_number(digest, 0, 99) + 11).cast("string"), *[_number(digest, i, 256).cast("string") for i in (1, 2, 3)]]
    ip = F.when(first == "10", F.concat_ws(".", first, *octets[1:])).when(
        private != "", F.concat(private, F.concat_ws(".", F.when(first == "127", octets[1]), *octets[2:]))).otherwise(
        F.concat_ws(".", *octets))

    def name(script: str, endings: int) -> Column:
        onsets, vowels = _SCRIPTS[script][:2]
        # Each tenth draw makes names a syllable longer, so there is always one left.
        places = range(2 + draw // 10)
        syllables = [_pick(digest, 3 * i + j, x) for i in places for j, x in enumerate((onsets, vowels))]
        return F.concat(*syllables, _pick(digest, 30, onsets), _pick(digest, 31, _SCRIPTS[script][endings]))

    of = F.split(kind, "_")
    names = F.lit(None).cast("string")
    for script in _SCRIPTS:
        made = F.when(of[1] == "m", name(script, 3)).when(of[1] == "f", name(script, 4)).otherwise(name(script, 2))
        names = F.when(of[2] == script, made).otherwise(names)
    iban = F.concat(F.substring(value, 1, 2), F.substring(shaped, F.lit(3), F.length(value)))
    return (F.when(kind == "card", F.concat(card, valid)).when(kind == "email", address).when(kind == "ipv4", ip)
            .when(kind == "iban", iban).when(kind.startswith("name"), names).otherwise(shaped))


def draw_surrogates(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value) rows.

    No two values of a kind share a surrogate, and none is a value of the table
    as long as its shape has others. A value that clashes is drawn again (of
    values that clash with each other, the smallest keeps its surrogate); the
    clashes of a draw are a small part of it, so the rounds get short quickly.
    Where a shape is so full that values still clash in the end, say addresses of
    192.168 that nearly all occur, these stand for one another, in an order that
    hangs on the key: distinct still, and none for itself.
    """
    pending, accepted = values, None
    for draw in range(DRAWS):
        drawn = pending.select("kind", "value", _draw(key, draw).alias("surrogate"))
        if accepted is not None:
            taken = accepted.select("kind", "surrogate").withColumn("taken", F.lit(True))
            drawn = drawn.join(taken, ["kind", "surrogate"], "left")
        else:
            drawn = drawn.withColumn("taken", F.lit(None).cast("boolean"))
        real = values.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        drawn = drawn.join(real, ["kind", "surrogate"], "left")
        place = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("value"))
        fits = F.col("taken").isNull() & F.col("real").isNull() & (place == 1)
        drawn = written(drawn.withColumn("fits", fits), f"surrogates-{draw}")
        fresh = drawn.filter("fits").select("kind", "value", "surrogate")
        accepted = fresh if accepted is None else accepted.unionByName(fresh)
        pending = drawn.filter("NOT fits").select("kind", "value")
        if pending.isEmpty():
            return accepted
    return accepted.unionByName(_exchanged(pending, key))


def _exchanged(values: DataFrame, key: str) -> DataFrame:
    """Each value stands for the next one of its kind and shape in the key's order,
    the last for the first. After all the draws a shape with a single value left
    is one without any other value, such as a shape of no letter and digit; that
    value stays."""
    sign = F.regexp_replace(F.regexp_replace("value", "[0-9]", "9"), r"\p{L}", "a")
    shape = F.when(F.col("kind") == "ipv4", F.regexp_extract("value", r"^(?:10\.|192\.168\.|127\.)?", 0)).otherwise(sign)
    ring = Window.partitionBy("kind", "shape").orderBy(_digest(key, F.col("kind"), F.col("value"), -1), "value")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shaped = values.withColumn("shape", shape)
    return shaped.select("kind", "value", F.coalesce(F.lead("value").over(ring), F.first("value").over(whole)).alias("surrogate"))


# Applying them

def _digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def _atoms(value: Column, kind: Column) -> Column:
    """What is mapped in a mention: (kind, canonical value, as written)."""
    title = F.regexp_extract(value, rf"^(?:({_TITLES})\.?[  ])?", 1)
    gender = F.when(title.isin(*_MALE), "m").when(title.isin(*_FEMALE), "f").otherwise("n")
    parts = F.split(F.regexp_replace(value, rf"^(?:{_TITLES})\.?[  ]", ""), r"[  ]")
    named = F.transform(parts, lambda p, i: F.struct(
        F.concat(F.lit("name_"), F.when(i == F.size(parts) - 1, "s").otherwise(gender), F.lit("_"),
                 _fold_script(p)).alias("kind"), F.lower(p).alias("value"), p.alias("raw")))
    bare = F.regexp_replace(value, r"^\+\d{1,3}(?=[ .(-])", "")
    secret = F.regexp_replace(value, _LEAD, "")
    plain = (F.when(kind == "phone", _digits(bare)).when(kind.isin("card", "ssn"), _digits(value))
             .when(kind == "email", F.lower(value)).when(kind == "iban", F.regexp_replace(value, " ", ""))
             .when(kind == "secret", secret).otherwise(value))
    raw = F.when(kind == "phone", bare).when(kind == "secret", secret).otherwise(value)
    one = F.array(F.struct(kind.alias("kind"), plain.alias("value"), raw.alias("raw")))
    return F.when(kind == "name", named).otherwise(one)


def _written_as(raw: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention it stands for."""
    # The next sign of the surrogate goes where the mention has a digit or letter.
    signs = F.split(raw, "")
    filled = F.array_join(F.transform(signs, lambda c, i: F.when(c.rlike(r"[A-Z0-9]"), F.substring(
        surrogate, F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^A-Z0-9]", "")), F.lit(1))).otherwise(c)), "")
    cased = F.when((F.length(raw) > 1) & (raw == F.upper(raw)), F.upper(surrogate)).when(
        F.substring(raw, 1, 1) != F.lower(F.substring(raw, 1, 1)), F.initcap(surrogate)).otherwise(surrogate)
    address = F.when((raw == F.upper(raw)), F.upper(surrogate)).otherwise(surrogate)
    return (F.when(kind.isin("phone", "card", "ssn", "iban"), filled).when(kind.startswith("name"), cased)
            .when(kind == "email", address).otherwise(surrogate))


def replace_private(docs: DataFrame, key: str, text: str = "text", report: str | None = None) -> DataFrame:
    """`docs` with each value of the text column replaced by its surrogate.

    All other columns stay. `report` names a column to add: array of the kinds
    replaced. NULL and empty texts stay; repeated rows get equal texts. Without
    the key a surrogate does not lead back to its value.
    """
    require(docs, [text])
    found, pattern = temporary(docs, "found"), temporary(docs, "pattern")
    body = F.coalesce(F.col(text), F.lit(""))
    marked = docs.withColumn(found, find(body))
    some = marked.filter(F.size(found) > 0).withColumn(pattern, _pattern(F.col(found)))
    # Searched again only where a name was found, for mentions of it without title.
    again = F.when(F.col(pattern) == _ANY, F.col(found)).otherwise(
        F.regexp_extract_all(body, F.col(pattern), F.lit(0)))
    some = some.withColumn(found, again)
    key_of = lambda c: F.sha2(F.array_join(c, "\x00"), 256)

    lists = some.select(F.col(found).alias("values"), _name_parts(F.col(found)).alias("names")).select(
        key_of(F.col("values")).alias("list"), "values", "names").dropDuplicates(["list"])
    mentions = lists.select("list", "names", "values", F.posexplode("values").alias("place", "mention"))
    mentions = mentions.withColumn("of", _kind(F.col("mention"))).withColumn("parts", _atoms(F.col("mention"), F.col("of")))
    # A name mentioned again has the kind that it had with its title.
    titled = F.flatten(F.transform(F.filter("values", lambda v: v.rlike(rf"^(?:{_TITLES})\.?[  ]")),
                                   lambda v: _atoms(v, F.lit("name"))))
    alone = ~F.col("mention").rlike(rf"^(?:{_TITLES})\.?[  ]")
    # So has one under a title that tells no gender, where another title does.
    named = lambda p: F.filter(titled, lambda t: t["value"] == p["value"])
    told = lambda p: F.filter(named(p), lambda t: ~t["kind"].startswith("name_n"))
    kind_of = lambda p: F.coalesce(F.get(told(p), F.lit(0))["kind"], F.get(named(p), F.lit(0))["kind"], p["kind"])
    same = F.transform("parts", lambda p: F.when(alone | p["kind"].startswith("name_n"), F.struct(
        kind_of(p).alias("kind"), p["value"].alias("value"), p["raw"].alias("raw"))).otherwise(p))
    mentions = mentions.withColumn("parts", F.when(F.col("of") == "name", same).otherwise(F.col("parts")))
    atoms = written(mentions.select("list", "place", "mention", "of", F.posexplode("parts").alias("part", "atom"))
                    .select("list", "place", "mention", "of", "part", "atom.*"), "mentions")
    surrogates = draw_surrogates(atoms.select("kind", "value").distinct(), key)
    made = atoms.join(surrogates, ["kind", "value"]).withColumn(
        "new", _written_as(F.col("raw"), F.col("kind"), F.col("surrogate")))
    in_order = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    whole = made.groupBy("list", "place", "mention", "of").agg(in_order("part", "new").alias("parts"))
    rest = F.when(F.col("of") == "name", F.regexp_extract("mention", rf"^(?:(?:{_TITLES})\.?[  ])?", 0)).when(
        F.col("of") == "phone", F.regexp_extract("mention", r"^\+\d{1,3}(?=[ .(-])", 0)).when(
        F.col("of") == "secret", F.regexp_extract("mention", _LEAD, 0)).otherwise("")
    whole = whole.withColumn("new", F.concat(rest, F.array_join(F.col("parts")["new"], " ")))
    ready = whole.groupBy("list").agg(in_order("place", "new", "of").alias("ready"))

    listed, joined = temporary(docs, "list"), temporary(docs, "ready")
    some = some.withColumn(listed, key_of(F.col(found))).join(
        ready.select(F.col("list").alias(listed), F.col("ready").alias(joined)), listed)
    between = F.split(F.col(text), F.col(pattern), -1)
    new = F.array_join(F.zip_with(between, F.col(joined)["new"], lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    done = some.withColumn(text, new)
    clean = marked.filter(F.size(found) == 0)
    kinds = F.array_distinct(F.col(joined)["of"])
    if report:
        done = done.withColumn(report, kinds)
        clean = clean.withColumn(report, F.array().cast("array<string>"))
    columns = [*docs.columns, *([report] if report and report not in docs.columns else [])]
    return clean.select(*columns).unionByName(done.select(*columns))

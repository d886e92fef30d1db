"""Personal data replaced by keyed surrogates of the same type, with DataFrame functions only.

Entities are found by one combined expression. Every distinct entity of the corpus gets a surrogate derived from a keyed
digest; surrogates that meet each other or an entity of the corpus are drawn again until all differ. The same entity has
the same surrogate everywhere, laid out in the format it is written in: digits stay digits, letters letters, separators
and case stay, card numbers that pass the check-digit test still do, addresses of machines lie in a reserved range, and
names keep their title, gender and script.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

# Titles and the gender they tell.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Госпожа", "Κυρία"],
    "u": ["Dr", "Doctor", "Prof", "Professor", "Mx"],
}
# Particles that stand before a family name and stay as they are.
PARTICLES = "van von der den de del della di da dos du la le les ten ter zu zum zur af av bin ibn al el y".split()
# Syllables of invented names and the ending of given names, by script.
SCRIPTS = {
    "Cyrillic": ("ба ве ги до жу за ки ла ме но ра са ти фе ху че".split(), {"m": "н", "f": "ва"}),
    "Greek": ("βα γε δι ζο θα κε λι μο νυ ξα πε ρι σο τα φε χι".split(), {"m": "ς", "f": "να"}),
    "Latin": ("ba de fi go hu ka le mi no pa re si to va we zu".split(), {"m": "n", "f": "na"}),
}
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLES = sorted((t for own in TITLES.values() for t in own), key=len, reverse=True)
_TITLE, _CAPITAL_TITLE = "|".join(_TITLES), "|".join(t.upper() for t in _TITLES)
_PARTICLE = "|".join(PARTICLES)
_INITIALS = "[" + "".join(sorted({t[0] for t in _TITLES})) + "]"  # asked first, since most places begin no title
# A part of a name: capitals anywhere, apostrophes and hyphens inside, or an initial with its dot. Possessive repeats are matched
# in a loop, so a name may have any number of parts.
_PART = r"(?:\p{Lu}\.|(?:[dl]['’])?\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{L}[\p{L}\p{M}]*+)*+)"
_NAME = rf"(?:(?:{_PARTICLE}) )*+{_PART}(?:[ -](?:(?:{_PARTICLE}) )*+{_PART})*+"
_CAPITAL_PART = r"(?:\p{Lu}\.|\p{Lu}(?:['’]\p{Lu}|[\p{Lu}\p{M}])[\p{Lu}\p{M}]*+(?:['’-]\p{Lu}[\p{Lu}\p{M}]*+)*+(?![\p{L}]))"
_CAPITAL_NAME = rf"{_CAPITAL_PART}(?:[ -]{_CAPITAL_PART})*+"
# In order of precedence. Look-behinds let a match begin at the start of a token only, so long tokens cost one pass, and no
# group repeats without a bound, since each repetition takes a stack frame.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+?[0-9]{0,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{2,4}[ .-]?[0-9]{3,4}"
    r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "person": rf"(?={_INITIALS})(?<!\p{{L}})(?:(?:{_TITLE})\.? {_NAME}|(?:{_CAPITAL_TITLE})\.? {_CAPITAL_NAME})",
}
KINDS = list(PATTERNS)
_ALL = "|".join(PATTERNS.values())
_HINT = rf"@|[0-9][0-9 .()-]{{5}}|(?={_INITIALS})(?<!\p{{L}})(?:{_TITLE}|{_CAPITAL_TITLE})\.? \p{{L}}"  # texts without any of these hold no entity
MAX_DRAWS = 40
LONGEST = 32  # syllables that a digest of 64 characters gives
NATIONAL = 10  # digits of a telephone number after the country code


def entities(text: Column) -> Column:
    """All entities of a text in order."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(_ALL), F.lit(0))), none)


def kind_of(entity: Column) -> Column:
    anchored = [(kind, entity.rlike(f"^(?:{pattern})$")) for kind, pattern in PATTERNS.items()]
    return reduce(lambda rest, one: F.when(one[1], F.lit(one[0])).otherwise(rest), reversed(anchored), F.lit("card"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _gender(entity: Column) -> Column:
    def titled(gender: str) -> Column:
        own = TITLES[gender] + [t.upper() for t in TITLES[gender]]
        return entity.rlike(rf"^(?:{'|'.join(own)})\.? ")

    return F.when(titled("f"), F.lit("f")).when(titled("u"), F.lit("u")).otherwise(F.lit("m"))


def identity_of(kind: Column, entity: Column) -> Column:
    """What all spellings of an entity share: case, separators, title and country code do not count."""
    name = F.regexp_replace(entity, r"^\S+ ", "")
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "ip", entity)
        .when(kind == "person", F.concat_ws(":", _gender(entity), F.lower(name)))
        .when(kind == "phone", F.substring(_digits(entity), -NATIONAL, NATIONAL))
        .otherwise(_digits(entity))
    )


def _number(seed: Column, at: int | Column, width: int) -> Column:
    return F.conv(F.substring(seed, F.lit(at) if isinstance(at, int) else at, F.lit(width)), 16, 10).cast("long")


def _digit_string(seed: Column) -> Column:
    """48 decimal digits from a hexadecimal digest."""
    return F.concat(*(F.substring(F.lpad(F.conv(F.substring(seed, 1 + 14 * k, 14), 16, 10), 17, "0"), 6, 12) for k in range(4)))


def _same_classes(value: Column, seed: Column) -> Column:
    """Letters and digits replaced by letters and digits, anything else kept."""

    def one(char: Column, place: Column) -> Column:
        number = _number(seed, (F.lit(1) + place * 2 % 62).cast("int"), 2)
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (number % 26 + 1).cast("int"), F.lit(1))
        return F.when(char.rlike("[a-z]"), letter).when(char.rlike("[0-9]"), (number % 10).cast("string")).otherwise(char)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _check_digit(body: Column) -> Column:
    """The digit that makes ``body`` followed by it pass the check-digit test of card numbers."""
    places = F.sequence(F.lit(1), F.length(body))
    doubled = F.array(*(F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(body, place, F.lit(1)).cast("int")
        return total + F.when((F.length(body) - place) % 2 == 0, F.get(doubled, digit)).otherwise(digit)

    return ((10 - F.aggregate(places, F.lit(0), add) % 10) % 10).cast("string")


def _tokens(name: Column) -> Column:
    """Runs of letters and runs of what stands between them, in order."""
    return F.regexp_extract_all(name, F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0))


def _invented_name(name: Column, gender: Column, key: str, draw: Column) -> Column:
    """Each word of a lower-case name becomes an invented one of the same script; particles and separators stay.

    Of several words the first takes the gender's ending; an initial becomes another initial. From the fourth draw on every
    draw has a syllable more than the one before, so one-word names do not run out.
    """
    parts = _tokens(name)
    places = F.sequence(F.lit(0), F.least(F.greatest(draw + 1, F.lit(3)), F.lit(LONGEST - 1)))

    def word(own: Column, place: Column) -> Column:
        seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("name"), own, draw.cast("string")), 256)

        def in_script(syllables: list[str], endings: dict[str, str]) -> Column:
            known = F.array(*map(F.lit, syllables))
            stem = F.array_join(F.transform(places, lambda k: F.get(known, _number(seed, 1 + 2 * k, 1).cast("int"))), "")
            ending = F.when(gender == "f", F.lit(endings["f"])).when(gender == "m", F.lit(endings["m"])).otherwise(F.lit(""))
            initial = F.substring(stem, 1, 1)
            return F.when(F.length(own) == 1, initial).when((place == 0) & (F.size(parts) > 1), F.concat(stem, ending)).otherwise(stem)

        scripts = [(own.rlike(rf"\p{{Is{s}}}"), in_script(*p)) for s, p in SCRIPTS.items()]
        invented = F.when(*scripts[0]).when(*scripts[1]).otherwise(scripts[2][1])
        return F.when(own.rlike(rf"^(?:[^\p{{L}}]+|{_PARTICLE})$"), own).otherwise(invented)

    return F.array_join(F.transform(parts, word), "")


def _in_case_of(model: Column, value: Column) -> Column:
    """``value`` in capitals where ``model`` has a capital at the same place, or throughout if ``model`` is all capitals."""
    capitals = (model == F.upper(model)) & (model != F.lower(model)) & (F.length(model) > 1)

    def one(char: Column, place: Column) -> Column:
        there = F.substring(model, (place + 1).cast("int"), F.lit(1))
        return F.when((there == F.upper(there)) & (there != F.lower(there)), F.upper(char)).otherwise(char)

    return F.when(capitals, F.upper(value)).otherwise(F.array_join(F.transform(F.split(value, ""), one), ""))


def _written_name(name: Column, surrogate: Column) -> Column:
    """An invented name in the case of the one it replaces, word by word; both have the same number of tokens."""
    return F.array_join(F.zip_with(_tokens(name), _tokens(surrogate), _in_case_of), "")


def surrogate_of(kind: Column, identity: Column, key: str, draw: Column) -> Column:
    """The identity of the surrogate that a draw gives to an entity."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, identity, draw.cast("string")), 256)
    digits, length = _digit_string(seed), F.length(identity)
    domain = F.substring_index(identity, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    local = _same_classes(F.substring_index(identity, "@", 1), seed)
    local = F.when(draw < 3, local).otherwise(F.concat(local, F.substring(digits, 1, 6)))  # short ones need more room
    email = F.concat(local, F.lit("@"), _same_classes(host, F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), domain), 256)), top)
    ip = F.concat_ws(".", _number(seed, 1, 2) % 15 + 240, *((_number(seed, 1 + 2 * k, 2)).cast("string") for k in (1, 2, 3)))
    body = F.concat(F.substring(identity, 1, 1), F.substring(digits, F.lit(1), length - 2))
    valid = _check_digit(F.substring(identity, F.lit(1), length - 1)) == F.substring(identity, -1, 1)
    card = F.concat(body, F.when(valid, _check_digit(body)).otherwise(F.substring(digits, -1, 1)))
    phone = F.concat((_number(seed, 60, 2) % 8 + 2).cast("string"), F.substring(digits, F.lit(1), length - 1))
    gender = F.substring(identity, 1, 1)
    person = F.concat_ws(":", gender, _invented_name(F.substring(identity, F.lit(3), length), gender, key, draw))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "person", person)
        .when(kind == "phone", phone)
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 1, 8)))  # never issued
        .otherwise(card)
    )


def _written(kind: Column, entity: Column, surrogate: Column) -> Column:
    """A surrogate in the layout of the entity it replaces."""
    digits = _digits(entity)
    wanted = F.concat(F.substring(digits, F.lit(1), F.length(digits) - F.length(surrogate)), surrogate)

    def lay(state: Column, char: Column) -> Column:
        is_digit = char.rlike("^[0-9]$")
        return F.struct(
            F.concat(state["out"], F.when(is_digit, F.substring(wanted, state["at"], F.lit(1))).otherwise(char)).alias("out"),
            (state["at"] + is_digit.cast("int")).alias("at"),
        )

    laid = F.aggregate(F.split(entity, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lay)["out"]
    title = F.regexp_extract(entity, r"^\S+ ", 0)
    invented = F.substring(surrogate, F.lit(3), F.length(surrogate))
    name = F.concat(title, _written_name(F.substring(entity, F.length(title) + 1, F.length(entity)), invented))
    email = F.concat_ws("@", *(_in_case_of(F.substring_index(entity, "@", n), F.substring_index(surrogate, "@", n)) for n in (1, -1)))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", surrogate)
        .when(kind == "person", name)
        .otherwise(laid)
    )


def draw_surrogates(known: DataFrame, key: str) -> DataFrame:
    """(kind, identity, surrogate) of distinct entities; surrogates of a kind differ from each other and from all entities.

    Of the entities that draw the same surrogate the smallest keeps it, and the rest draw again. The unsettled part
    shrinks with every round and each round is written to the shared folder.
    """
    pending, settled = known, None
    for draw in range(MAX_DRAWS):
        drawn = pending.withColumn("surrogate", surrogate_of(F.col("kind"), F.col("identity"), key, F.lit(draw)))
        ranked = drawn.selectExpr("*", "row_number() OVER (PARTITION BY kind, surrogate ORDER BY identity) AS place")
        taken = known.select("kind", F.col("identity").alias("surrogate"), F.lit(True).alias("taken"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate", F.lit(True).alias("taken")))
        tried = materialise(ranked.join(taken.distinct(), ["kind", "surrogate"], "left"), "privacy-draw")
        good = tried.filter("place = 1 AND taken IS NULL").select("kind", "identity", "surrogate")
        settled = good if settled is None else settled.unionByName(good)
        pending = tried.filter("place > 1 OR taken IS NOT NULL").select("kind", "identity")
        if pending.isEmpty():
            return settled
    raise RuntimeError("the formats leave no room for distinct surrogates")


def _replace_known(gap: Column, names: Column) -> Column:
    """Full names among ``names`` (name, invented), longest first, wherever they stand alone."""

    def one(text: Column, own: Column) -> Column:
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{M}'’-])\Q"), own["name"], F.lit(r"\E(?![\p{L}\p{M}])"))
        return F.regexp_replace(text, pattern, own["invented"])

    return F.aggregate(names, gap, one)


def replace_entities(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns, entities of the text replaced, with ``n_<kind>`` counts of replaced entities appended.

    Persons are found by their titles; a full name of two or more parts that has a title somewhere in a text is also replaced
    where it stands without one in that text (not counted). Texts without entities are passed on as they are, null texts
    too (counts 0). Rows are told apart by 128-bit digests of id and text, so null and repeated ids are fine. Columns that
    had one of the appended names are replaced; names that begin with two underscores are reserved. Texts that hold
    entities are written once, so a text is searched twice at most.
    """
    docs = docs.drop(*(f"n_{kind}" for kind in KINDS))
    names = docs.columns
    text = F.col(text_column)
    rows = docs.withColumns({
        "__k1": F.xxhash64(id_column, text_column), "__k2": F.xxhash64(F.lit(1), text_column, id_column), "__found": entities(text)
    })
    holding, plain = materialise(rows.filter(F.size("__found") > 0), "privacy-holding"), rows.filter(F.size("__found") == 0)
    seen = holding.select("__k1", "__k2", F.explode(F.array_distinct("__found")).alias("entity")).withColumn("kind", kind_of(F.col("entity")))
    seen = materialise(
        seen.select("__k1", "__k2", "kind", identity_of(F.col("kind"), F.col("entity")).alias("identity")).distinct(), "privacy-seen"
    )
    known = materialise(seen.select("kind", "identity").distinct(), "privacy-known")
    settled = materialise(draw_surrogates(known, key), "privacy-surrogates")
    maps = seen.join(settled, ["kind", "identity"]).groupBy("__k1", "__k2").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "kind", "identity"), F.col("surrogate")))).alias("__map")
    )

    def write(entity: Column) -> Column:
        kind = kind_of(entity)
        return _written(kind, entity, F.element_at("__map", F.concat_ws(" ", kind, identity_of(kind, entity))))

    done = holding.join(maps, ["__k1", "__k2"]).withColumns({"__kinds": F.transform("__found", kind_of), "__written": F.transform("__found", write)})
    pairs = F.arrays_zip("__found", "__written", "__kinds")
    titled = F.filter(pairs, lambda p: p["__kinds"] == "person")

    def untitled(entity: Column) -> Column:
        return F.regexp_replace(entity, r"^\S+ ", "")

    full = F.transform(titled, lambda p: F.struct(
        F.length(untitled(p["__found"])).alias("size"), untitled(p["__found"]).alias("name"), untitled(p["__written"]).alias("invented")))
    full = F.filter(full, lambda n: n["name"].contains(" "))
    done = done.withColumn("__names", F.sort_array(F.array_distinct(full), asc=False))
    gaps = F.transform(F.split(text, _ALL), lambda gap: F.when(F.size("__names") > 0, _replace_known(gap, F.col("__names"))).otherwise(gap))
    parts = F.zip_with(gaps, "__written", lambda gap, own: F.concat(gap, F.coalesce(own, F.lit(""))))
    counts = {f"n_{k}": F.size(F.filter("__kinds", _equals(k))).cast("long") for k in KINDS}
    done = done.withColumns({text_column: F.array_join(parts, ""), **counts})
    untouched = plain.withColumns({f"n_{kind}": F.lit(0).cast("long") for kind in KINDS})
    columns = [*names, *counts]
    return done.select(*columns).unionByName(untouched.select(*columns))


def _equals(kind: str):
    return lambda value: value == kind

"""Personal data replaced by keyed surrogates of the same kind, format and script.

Everything runs in built-in functions. A text is cut at its matches; each match becomes its surrogate; the parts are
joined again. A surrogate depends on the key, the kind, the entity and an attempt number, so an entity has the same
surrogate wherever it occurs. The attempt is 0 but for entities whose surrogate would be another's or a real entity.
"""

from __future__ import annotations

import hashlib
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherlake.llm.common import packed, stored

# Given names by script and gender, and forms of address.
GIVEN_NAMES = {
    "latin male": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Daniel", "Peter", "Hans", "Pierre", "Carlos"],
    "latin female": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Greta", "Claire", "Carmen"],
    "cyrillic male": ["Иван", "Пётр", "Сергей", "Дмитрий", "Николай", "Олег"],
    "cyrillic female": ["Анна", "Мария", "Ольга", "Елена", "Ирина", "Наталья"],
}
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Mme", "Sr", "Sra"]
# Vowels by script, so that what replaces a name can be spoken; and endings that mark a name's gender.
VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿаеёиоуыэюяαεηιουωіїєāēīōūęąőű"
ENDINGS = ["ова", "ева", "ина", "ская", "цкая", "ов", "ев", "ин", "ский", "цкий"]
# Blocks of scripts, by their first and last code point.
BLOCKS = {
    "latin": (0x61, 0x7A), "latin accents": (0xDF, 0xFF), "latin extended": (0x100, 0x17F), "latin additional": (0x1E00, 0x1EFF),
    "greek": (0x3B1, 0x3C9), "greek extended": (0x370, 0x3FF), "cyrillic": (0x430, 0x44F), "cyrillic extended": (0x450, 0x4FF),
    "armenian": (0x530, 0x58F), "hebrew": (0x5D0, 0x5EA), "arabic": (0x620, 0x64A),
    "devanagari": (0x904, 0x939), "bengali": (0x985, 0x9B9), "tamil": (0xB85, 0xBB9), "thai": (0xE01, 0xE2E), "georgian": (0x10D0, 0x10FF),
    "hiragana": (0x3041, 0x3096), "katakana": (0x30A1, 0x30FA), "hangul": (0xAC00, 0xAD00), "han": (0x4E00, 0x4F00),
}
# Scripts with more letters than those above stand for the letters of the whole range.
WIDE = {"han": r"\p{IsHan}", "hangul": r"\p{IsHangul}"}


def _alphabets() -> list[tuple[str, str]]:
    """(test, letters): a character that passes the test is replaced by one of the letters. The last two take what is left."""
    found = [(r"[0-9]", "0123456789")]
    for name, (first, last) in BLOCKS.items():
        letters = [chr(c) for c in range(first, last + 1)]
        if name in WIDE:
            found.append((WIDE[name], "".join(c for c in letters if unicodedata.category(c) == "Lo")))
            continue
        lower = [c for c in letters if unicodedata.category(c) in ("Ll", "Lo")]
        for sound in (True, False):
            own = "".join(c for c in lower if (unicodedata.normalize("NFD", c)[0] in VOWELS or c in VOWELS) == sound)
            upper = "".join(c.upper() for c in own if len(c.upper()) == 1 and c.upper() != c)
            found += [(f"[{cased}]", cased) for cased in (own, upper) if len(cased) > 1]
    return [*found, (r"\p{N}", "0123456789"), (r"[\p{L}\p{M}]", "abcdefghijklmnopqrstuvwxyz")]


ALPHABETS = _alphabets()

_given = "|".join(name for names in GIVEN_NAMES.values() for name in names)
_titles = "|".join(TITLES)
_word = r"\p{Lu}\p{Ll}{1,20}"
_octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# The kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+-]{0,63}+@(?:[\p{L}\p{M}\p{N}-]{1,40}\.){1,3}\p{L}{2,12}",
    "ip": rf"(?<![\d.])(?:{_octet}\.){{3}}{_octet}(?![\d]|\.\d)",
    "phone": r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "person number": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,4}(?!\d)",
    "secret": r"(?<![\p{L}\p{N}])[0-9a-f]{32,64}(?![\p{L}\p{N}])",
    "given": rf"(?=\p{{Lu}})(?<!\p{{L}})(?:{_given})(?= {_word})",
    "name": rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{_given}) |(?<!\p{{L}})(?:{_titles})\.? |(?<!\p{{L}})(?:{_titles})\.? {_word} ){_word}(?!\p{{L}})",
}
ENTITY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# What every match has or follows; a quick test that spares most texts the search.
SIGNS = rf"\d\.?\d|@|[0-9a-f]{{32}}|(?=\p{{Lu}})(?:{_given}|{_titles})(?!\p{{Ll}})"
DIGIT_KINDS = ("phone", "card", "person number")
# Cuts a text between any two characters.
CHARACTERS = r"(?s)(?<=.)(?=.)"
# Bytes of the keyed stream: one a character of the longest match as it is lengthened at most.
STREAM_BYTES = 256
# From this attempt on a name or address gets a letter more each time, and after the last one an entity is masked.
LENGTHENED = 3
LAST_ATTEMPT = 24


def matches_in(text: Column) -> Column:
    """All matches of a text in order, none in a null text."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(SIGNS), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(none)


def kind_of(match: Column) -> Column:
    """The kind of a match, by what it is made of; the patterns exclude each other this far."""
    digits = F.regexp_replace(match, r"\D", "")
    return (
        F.when(match.contains("@"), "email")
        .when(match.rlike(rf"^(?:{_octet}\.){{3}}{_octet}$"), "ip")
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "person number")
        .when(match.rlike(r"^[0-9a-f]{32,64}$"), "secret")
        .when(match.rlike(r"^[\d -]+$") & (F.length(digits) >= 13), "card")
        .when(match.rlike(r"^[+(\d]"), "phone")
        .when(match.rlike(rf"^(?:{_given})$"), "given")
        .otherwise("name")
    )


def entity_of(kind: Column, match: Column) -> Column:
    """What makes two matches the same entity, whatever their spelling."""
    return (
        F.when(kind == "email", F.lower(match))
        .when(kind.isin(*DIGIT_KINDS), F.regexp_replace(match, r"\D", ""))
        .otherwise(match)
    )


def _passes_luhn(digits: Column) -> Column:
    """Whether a string of digits has the check digit that card numbers have."""
    reversed_ = F.transform(F.split(F.reverse(digits), CHARACTERS), lambda d: d.cast("int"))
    values = F.transform(reversed_, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def surrogate_entity(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """The entity that stands for another, each character by one of its own alphabet.

    Letters stay in their script and case, and vowels are vowels; a letter or digit of a script without an alphabet here
    becomes a Latin letter or an ASCII digit. An address keeps its last label, a phone number what comes before its last ten digits, a
    card number its check digit's truth, and a name the ending that marks its gender. Given names come from the list of their
    script and gender. Beyond LAST_ATTEMPT the surrogate is a mask, the kind and a digest in brackets, which is no entity.
    """
    seed = F.concat_ws("|", F.lit(key), kind, entity, attempt.cast("string"))
    blocks = [F.sha2(F.concat_ws("|", seed, F.lit(str(k))), 256) for k in range(STREAM_BYTES // 32)]
    more = F.greatest(attempt - LENGTHENED, F.lit(0))
    longer = (
        F.when(kind == "name", F.concat(entity, F.repeat(F.right(entity, F.lit(1)), more)))
        .when(kind == "email", F.concat(F.repeat(F.left(entity, F.lit(1)), more), entity))
        .otherwise(entity)
    )
    # One struct in a list of one: the stream is made once for the entity, not once for each character.
    inputs = F.array(F.struct(F.concat(*blocks).alias("hex"), longer.alias("entity")))
    made = F.transform(inputs, lambda s: _from_stream(kind, s["entity"], s["hex"]))
    masked = F.concat(F.lit("["), kind, F.lit(" "), F.left(F.sha2(seed, 256), F.lit(32)), F.lit("]"))
    return (
        F.when(kind == "given", _given_surrogate(key, entity)).when(attempt > LAST_ATTEMPT, masked).otherwise(F.get(made, F.lit(0)))
    )


def _from_stream(kind: Column, entity: Column, stream: Column) -> Column:
    def byte(i: Column) -> Column:
        return F.conv(F.substring(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")

    def own_kind(c: Column, i: Column) -> Column:
        # Two bytes choose, as some alphabets have more than 256 letters.
        number = byte(i) * 256 + byte(F.lit(STREAM_BYTES - 1) - i)
        chosen = F
        for test, letters in ALPHABETS:
            chosen = chosen.when(c.rlike(test), F.substring(F.lit(letters), number % len(letters) + 1, F.lit(1)))
        return chosen.otherwise(c)

    hexes = "0123456789abcdef"
    last = F.length(F.substring_index(entity, ".", -1))
    ending = F.length(F.regexp_extract(entity, f"({'|'.join(ENDINGS)})$", 1))
    kept_front = F.when(kind == "phone", F.greatest(F.length(entity) - 10, F.lit(0))).otherwise(0)
    kept_back = F.when(kind == "email", last).when(kind == "name", ending).otherwise(0)
    characters = F.transform(
        F.split(entity, CHARACTERS),
        lambda c, i: F.when((i < kept_front) | (i >= F.length(entity) - kept_back), c)
        .when(kind == "secret", F.substring(F.lit(hexes), byte(i) % 16 + 1, F.lit(1)))
        .otherwise(own_kind(c, i)),
    )
    text = F.array_join(characters, "")
    octets = F.array_join(F.transform(F.split(entity, r"\."), lambda o, i: (byte(i) % 254 + 1).cast("string")), ".")
    # Of the ten last digits one gives the number the truth of the check digit that the entity has.
    with_check = F.get(
        F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(F.substring(text, F.lit(1), F.length(text) - 1), d.cast("string"))),
            lambda n: _passes_luhn(n) == _passes_luhn(entity),
        ),
        F.lit(0),
    )
    return F.when(kind == "ip", octets).when(kind == "card", with_check).otherwise(text)


def _given_surrogate(key: str, name: Column) -> Column:
    """Each given name's follower in the keyed order of its list: another name, and no two names have the same."""
    pairs = []
    for names in GIVEN_NAMES.values():
        order = sorted(names, key=lambda n: hashlib.sha256(f"{key}|{n}".encode()).hexdigest())
        pairs += zip(order, order[1:] + order[:1])
    return F.element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), name)


def rendered(kind: Column, match: Column, entity: Column) -> Column:
    """The surrogate entity in the spelling of the match: its separators, and its capitals in an address."""
    characters = F.split(match, CHARACTERS)
    digits = F.array_join(
        F.transform(
            characters,
            lambda c, i: F.when(
                c.rlike(r"\d"),
                F.substring(entity, F.length(F.regexp_replace(F.substring(match, F.lit(1), i + 1), r"\D", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    letters = F.array_join(
        F.transform(
            characters,
            lambda c, i: F.when(c != F.lower(c), F.upper(F.substring(entity, i + 1, F.lit(1)))).otherwise(F.substring(entity, i + 1, F.lit(1))),
        ),
        "",
    )
    same_length = F.length(entity) == F.length(match)
    return F.when(entity.startswith("["), entity).when(kind.isin(*DIGIT_KINDS), digits).when((kind == "email") & same_length, letters).otherwise(entity)


def entities(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """kind and entity of each match that has a surrogate of its own, from all texts."""
    matches = docs.select(F.explode(F.array_distinct(matches_in(F.col(f"`{text_column}`")))).alias("match"))
    kinds = matches.withColumn("kind", kind_of(F.col("match")))
    return kinds.select("kind", entity_of(F.col("kind"), F.col("match")).alias("entity")).where("kind <> 'given'")


def settled_attempts(found: DataFrame, key: str) -> DataFrame:
    """kind, entity, attempt for the entities whose attempt is not 0.

    `found` has each entity once. In each round the surrogates are grouped: of entities with the same surrogate the first
    in order keeps it, and an entity whose surrogate is another real entity keeps none; the others try the next number.
    Entities are only counted and joined by themselves or their surrogates, which are as many. Names and addresses grow with the
    attempts, and after LAST_ATTEMPT an entity gets its mask, so the rounds are at most LAST_ATTEMPT + 2.
    """
    surrogate = surrogate_entity(key, F.col("kind"), F.col("entity"), F.col("attempt"))
    state = stored(found.withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate), "surrogates")
    while True:
        first = state.groupBy("kind", "surrogate").agg(F.min("entity").alias("owner"), F.count("*").alias("n"))
        real = found.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("is_real"))
        taken = first.join(real, ["kind", "surrogate"], "left").where("n > 1 or is_real")
        again = state.join(taken, ["kind", "surrogate"]).where("entity <> owner or is_real")
        moved = stored(again.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "again")
        if moved.isEmpty():
            return state.where("attempt > 0").select("kind", "entity", "attempt")
        kept = state.join(moved, ["kind", "entity"], "left_anti")
        state = stored(kept.unionByName(moved.withColumn("surrogate", surrogate)), "surrogates")


def replace_entities(docs: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """One row per input row: `row` (the input row as a struct), `text` with surrogates, and counts n_<kind> and n_entities.

    Null texts stay null and have no entities; a text without entities is unchanged. Repeated rows get the same text. Two
    entities of a kind never share a surrogate, no surrogate is a real entity of its kind, and an entity has one
    surrogate in all texts. Given names are the exception: each stands for another of its list, so a surrogate may be a name
    that occurs. An empty table gives an empty result. `key` must be kept secret and not be empty.

    The entities of all texts are made distinct by a grouping that each task starts on its own rows, so a frequent
    one is a row a task. Only texts that hold an entity with an attempt other than 0 are joined to it, by their digest.
    """
    if not key:
        raise ValueError("the key must not be empty")
    found = stored(entities(docs, text_column).distinct(), "entities")
    attempts = stored(settled_attempts(found, key), "attempts")
    text = F.col(f"`{text_column}`")
    digest = F.xxhash64(text), F.md5(text)
    rows = docs.select(packed(docs).alias("row"), text.alias("old"), *[d.alias(f"digest{k}") for k, d in enumerate(digest)])

    # Attempts by text, for the few texts that need them; copies of a text are one row here.
    if attempts.isEmpty():
        fixed = rows.withColumn("attempts", F.lit(None).cast("map<string,int>"))
    else:
        where = docs.select(*[d.alias(f"digest{k}") for k, d in enumerate(digest)], F.explode(F.array_distinct(matches_in(text))).alias("match"))
        held = where.withColumn("kind", kind_of(F.col("match")))
        held = held.select("digest0", "digest1", "kind", entity_of(F.col("kind"), F.col("match")).alias("entity")).distinct()
        pair = F.struct(F.concat_ws("|", "kind", "entity"), F.col("attempt"))
        fixes = held.join(attempts, ["kind", "entity"]).groupBy("digest0", "digest1").agg(F.map_from_entries(F.collect_set(pair)).alias("attempts"))
        fixed = rows.join(stored(fixes, "fixes"), ["digest0", "digest1"], "left")

    cut = fixed.withColumn("matches", matches_in(F.col("old")))
    described = F.transform("matches", lambda m: F.struct(m.alias("match"), kind_of(m).alias("kind")))
    described = F.transform(
        described, lambda d: F.struct(d["match"].alias("match"), d["kind"].alias("kind"), entity_of(d["kind"], d["match"]).alias("entity"))
    )
    cut = cut.withColumn("found", described)

    def attempt(d: Column) -> Column:
        return F.coalesce(F.try_element_at("attempts", F.concat_ws("|", d["kind"], d["entity"])), F.lit(0))

    made = F.transform(
        "found",
        lambda d: F.struct(
            d["match"].alias("match"),
            d["kind"].alias("kind"),
            surrogate_entity(key, d["kind"], d["entity"], attempt(d)).alias("entity"),
        ),
    )
    cut = cut.withColumn("made", made)
    cut = cut.withColumn("new", F.transform("made", lambda d: rendered(d["kind"], d["match"], d["entity"])))
    between = F.split("old", ENTITY)
    joined = F.array_join(
        F.flatten(F.zip_with(between, F.col("new"), lambda part, new: F.array(F.coalesce(part, F.lit("")), F.coalesce(new, F.lit(""))))), ""
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda d: d["kind"] == kind)).cast("long").alias(f"n_{kind.replace(' ', '_')}")

    return cut.select(
        "row",
        F.when(F.size("matches") > 0, joined).otherwise(F.col("old")).alias("text"),
        *[count(kind) for kind in PATTERNS],
        F.size("matches").cast("long").alias("n_entities"),
    )

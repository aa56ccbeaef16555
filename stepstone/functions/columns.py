"""Column expressions shared by the operators: no UDFs, everything stays in the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# Review states, punctuation sets and stage bounds that decide results.
REVIEW_STATES = ("machine", "reviewed", "rejected")
NAME_NOISE = r"[·：:（）()《》“”\"'、，,\s]"
NAME_WORDS = "的|与|和"
GRAM_NOISE = r"[\s（）()·、,，。:：；;《》“”\"']"
STAGE_BOUNDS = ((8, "primary"), (10, "primary-mid"), (12, "primary-hi"), (15, "junior"))
LAST_STAGE = "senior"
UUID_NAMESPACE = "4b6f5c55c9c64b2da5d8bf17f9b53e20"

REVIEWER_LABELS = {
    "teacher": "teacher review",
    "curator": "curated",
    "ai-consensus": "model consensus",
    "rule": "rule",
    "upstream": "upstream",
}


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def review_state(status: str | Column) -> Column:
    """Unknown and missing review states count as ``machine``."""
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status.isin(*REVIEW_STATES), status).otherwise(F.lit("machine"))


def reviewer_label(role: Column, provenance: Column, labels: Mapping[str, str] = REVIEWER_LABELS) -> Column:
    """Public evidence label of an edge: the role wins over the provenance."""
    out = F.when(role == "teacher", labels["teacher"]).when(role == "curator", labels["curator"])
    for value in ("ai-consensus", "rule", "upstream"):
        out = out.when(provenance == value, labels[value])
    return out.otherwise(F.lit(""))


def normalised_name(name: str | Column) -> Column:
    """Name with punctuation, blanks and filler words removed, for collision tests."""
    stripped = F.regexp_replace(F.coalesce(name, F.lit("")), NAME_NOISE, "")
    return F.regexp_replace(stripped, NAME_WORDS, "")


def age_stage(
    age: str | Column, bounds: Sequence[tuple[int, str]] = STAGE_BOUNDS, last: str = LAST_STAGE
) -> Column:
    age = F.col(age) if isinstance(age, str) else age
    out = F.when(age <= bounds[0][0], bounds[0][1])
    for limit, label in bounds[1:]:
        out = out.when(age <= limit, label)
    return out.otherwise(last)


def bigrams(text: str | Column, noise: str = GRAM_NOISE) -> Column:
    """Distinct two-character substrings of ``text`` without punctuation and blanks."""
    chars = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), noise, ""), "")
    size = F.greatest(F.size(chars) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(chars, 1, size), F.slice(chars, 2, size), lambda a, b: F.concat(a, b)))


def gram_codes(text: str | Column, noise: str = GRAM_NOISE) -> Column:
    """The bigrams as one number each, made of both code points: cheaper to hash, ship and intersect."""
    chars = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), noise, ""), "")
    codes = F.transform(chars, lambda c: F.ascii(c).cast("bigint"))
    size = F.greatest(F.size(chars) - 1, F.lit(0))
    # code points stay below 2^21
    return F.array_distinct(F.zip_with(F.slice(codes, 1, size), F.slice(codes, 2, size), lambda a, b: a * 2097152 + b))


def gram_cosine(left: Column, right: Column) -> Column:
    """Shared grams over the geometric mean of both set sizes, 0 when either set is empty."""
    product = F.size(left).cast("double") * F.size(right)
    return F.when(product > 0, F.size(F.array_intersect(left, right)) / F.sqrt(product)).otherwise(F.lit(0.0))


def stable_uuid(name: str | Column, namespace: str = UUID_NAMESPACE) -> Column:
    """Version-5 shaped UUID: SHA-1 of namespace and name with version and variant bits set."""
    name = F.col(name) if isinstance(name, str) else name
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble.bitwiseAND(F.lit(3)) + 8))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def canonical_json(*cols: str) -> Column:
    """JSON of the columns in alphabetical order; nulls are left out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "true"})


def _sorted_inside(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StructType):
        fields = [_sorted_inside(value.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda v: _sorted_inside(v, kind.elementType))
    if isinstance(kind, MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), _sorted_inside(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(F.array_sort(pairs, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))
    return value


def nested_canonical_json(schema: StructType, *cols: str) -> Column:
    """JSON of the columns with the keys in alphabetical order at every depth; null fields are left out, lists keep their order."""
    kinds = {f.name: f.dataType for f in schema.fields}
    parts = [_sorted_inside(F.col(c), kinds[c]).alias(c) for c in sorted(cols)]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "true"})


def fingerprint(*cols: str) -> Column:
    return F.sha2(canonical_json(*cols), 256)


def row_digest(*cols: str | Column) -> Column:
    """60-bit digest of a row, made to be summed: equal bags of rows give equal sums.

    Values carry their lengths, so no two rows are the same text.
    """
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~")) for v in values]
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def exact_text(value: Column) -> Column:
    """A text that tells every floating-point number from every other, zeros by their sign.

    Numbers of usual size are two integers: that of 2^-20 units, and the rest in 2^-72 units.  Multiplying by powers of two is
    exact, and 53 bits from 2^-20 on end at 2^-72.  All others are hexadecimal, as C prints them but for the plus of exponents.
    """
    x = value.cast("double")
    units = F.floor(x * 2.0**20)
    rest = ((x * 2.0**20 - units) * 2.0**52).cast("bigint")
    usual = F.abs(x).between(2.0**-20, 2.0**42)
    digits = F.replace(F.lower(F.format_string("%a", x)), F.lit(".0p"), F.lit("p"))
    return F.when(usual, F.concat_ws(".", units.cast("string"), rest.cast("string"))).when(x == 0, x.cast("string")).when(
        value.isNotNull(), F.replace(digits, F.lit("infinity"), F.lit("inf"))
    )


def conjunction_split(name: str | Column, part: int, conjunctions: str = "与和") -> Column:
    """Part 1 or 2 of a name cut at its first conjunction, empty when there is none."""
    return F.regexp_extract(name, f"^(.+?)[{conjunctions}](.+)$", part)


def whole_word_replace(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Case-insensitive whole-word replacement in list order; word limits are ASCII ones."""
    edge = "[A-Za-z0-9_]"
    out = text
    for word, good in pairs:
        quoted = re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", word)
        out = F.regexp_replace(out, f"(?i)(?<!{edge}){quoted}(?!{edge})", good)
    return out


# The name placeholder, its stand-in, and what a translation may leave of it.
PLACEHOLDER, GUARD = "{{name}}", "孩子X名X"


def guard_placeholder(text: Column) -> Column:
    """Swap the name placeholder for a token that survives translation."""
    return F.replace(text, F.lit(PLACEHOLDER), F.lit(GUARD))


def restore_placeholder(text: Column) -> Column:
    return F.regexp_replace(text, "孩子X?名X?", PLACEHOLDER)

"""Column functions. Every limit, list and label is a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: A decimal number as text, with or without sign, fraction and exponent.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def norm_id(c: str | Column) -> Column:
    """Trimmed text; blank is null; what reads as a whole number is written as one (``007``, ``+7``, ``7.0`` and ``7e0`` are ``7``)."""
    text = F.regexp_replace(col(c).cast("string"), r"^\s+|\s+$", "")
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    whole = (number == F.floor(number)) & (F.abs(number) < 2.0**53)
    return F.when(text == "", None).when(whole, number.cast("long").cast("string")).otherwise(text)


def norm_key(columns: Sequence[str], times: Sequence[str] = (), whole: Sequence[str] = ()) -> Column:
    """A key text: parts joined by a bar (bars and backslashes within them escaped), times to the second, nulls as empty parts.

    Columns ``whole`` have a whole-number type and are written as they are; ``whole_columns`` names them.
    """
    plain = lambda c: F.col(c).cast("string") if c in whole else F.regexp_replace(norm_id(c), r"([|\\])", r"\\$1")
    parts = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c in times else plain(c) for c in columns]
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])


def whole_columns(*frames: DataFrame) -> list[str]:
    """Columns that have a whole-number type in every frame."""
    kinds = [{c for c, k in f.dtypes if k in ("tinyint", "smallint", "int", "bigint")} for f in frames]
    return sorted(set.intersection(*kinds))


def is_zero(c: str | Column, zero: float = 0) -> Column:
    """Equal to zero (or what stands for it); null isn't zero."""
    return F.coalesce(col(c) == zero, F.lit(False))


def status2(c: str | Column, limit: float, low: str = "BSL", high: str = "HIGHFLIER") -> Column:
    """``low`` under the limit, else ``high``; null is ``high``."""
    return F.when(col(c) < limit, low).otherwise(high)


def class4(c: str | Column, limit: float, labels: tuple[str, str, str, str] = ("UNKNOWN", "ZERO", "BSL", "HIGHFLIER")) -> Column:
    """Labels of null, of zero, of what lies between zero and the limit, and of all else (the limit itself and negatives too)."""
    unknown, zero, low, high = labels
    return F.when(col(c).isNull(), unknown).when(col(c) == 0, zero).when((col(c) > 0) & (col(c) < limit), low).otherwise(high)


def density_sum(*parts: str) -> Column:
    """Sum of parts read as numbers, null or unreadable ones being 0."""
    out = F.lit(0.0)
    for p in parts:
        out = out + F.coalesce(col(p).try_cast("double"), F.lit(0.0))
    return out


def rollout_status(priority: str, base: tuple[str, str], labels: tuple[str, str, str, str], suffixes: dict[str, str], *, priority_label: str = "PRIORITY", error: str = "ERROR", off_unless_on: bool = False) -> Column:
    """The priority's label alone if its flag is ON; else a base label, with a suffix for each further flag that is ON.

    Base labels are for neither flag, the first, the second and both; a base flag that is neither ON nor OFF (null too) gives ``error``,
    or counts as OFF if ``off_unless_on``.
    """
    on = lambda c: F.coalesce(F.col(c) == "ON", F.lit(False))
    known = F.lit(True) if off_unless_on else F.coalesce(F.col(base[0]).isin("ON", "OFF") & F.col(base[1]).isin("ON", "OFF"), F.lit(False))
    neither, first, second, both = labels
    out = F.when(~known, error).when(on(base[0]) & on(base[1]), both).when(on(base[0]), first).when(on(base[1]), second).otherwise(neither)
    for c, s in suffixes.items():
        out = F.concat(out, F.when(on(c), F.lit(s)).otherwise(F.lit("")))
    return F.when(on(priority), F.lit(priority_label)).otherwise(out)


def rollout_short(priority: str | None, on_label: str, off_label: str) -> Column:
    return F.lit("") if priority is None else F.when(F.col(priority) == "ON", on_label).otherwise(off_label)


def recipe_group(
    recipe: str | Column, technology: str | Column, is_test: Column, text: str | Column, *, monitor_prefixes: Sequence[str], monitor_words: Sequence[str], monitor: str, layer_rule: tuple[str, str, str], special_prefix: str, special_suffix: str, keywords: dict[str, dict[str, str]], other: str = "OTHER"
) -> Column:
    """A recipe's group, by the first rule that holds.

    Null is ``other``; monitors (prefixes, words) and test lots are ``monitor``; of one technology a text that holds a
    layer's digit is the layer's (``layer_rule``: technology, digit, label); special recipes are named by the
    technology's last letter, even of an unknown one; then the technology's own keywords in order; else ``other``.
    """
    r = F.upper(col(recipe))
    test = F.coalesce(is_test, F.lit(False))
    out = F.when(r.isNull(), other)
    for prefix in monitor_prefixes:
        out = out.when(r.startswith(prefix), monitor)
    for word in monitor_words:
        out = out.when(r.contains(word), monitor)
    tech, digit, label = layer_rule
    out = out.when(test, monitor).when((col(technology) == tech) & col(text).contains(digit), label)
    out = out.when(r.startswith(special_prefix), F.concat(F.right(F.coalesce(col(technology), F.lit("UNKNOWN")), F.lit(1)), F.lit(special_suffix)))
    for own, words in keywords.items():
        for word, name in words.items():
            out = out.when((col(technology) == own) & r.contains(word), name)
    return out.otherwise(other)


def technology(c: str | Column, letters: dict[str, str], place: int = 4) -> Column:
    """By the letter at ``place``; others UNKNOWN."""
    letter = F.substring(col(c), place, 1)
    out = F.when(F.lit(False), "")
    for k, v in letters.items():
        out = out.when(letter == k, v)
    return out.otherwise("UNKNOWN")


def is_test(lot: str | Column, mark: str) -> Column:
    return col(lot).contains(mark)


def layer_match(layer: str | Column, technology: str | Column, is_test: Column, text: str | Column, patterns: dict[str, tuple[str, Sequence[str]]]) -> Column:
    """Whether a unit is of its layer: no test lot, of the layer's technology, and the text holds one of its words; layers without a pattern don't match."""
    out = F.lit(False)
    for name, (tech, words) in patterns.items():
        held = F.lit(False)
        for word in words:
            held = held | col(text).contains(word)
        out = out | ((col(layer) == name) & (col(technology) == tech) & F.coalesce(held, F.lit(False)))
    return F.coalesce(out, F.lit(False)) & ~F.coalesce(is_test, F.lit(False))


def is_product(is_test: Column, group: str | Column, monitor: str) -> Column:
    """Neither a test lot nor of the monitors' group; a null group is not theirs."""
    return ~F.coalesce(is_test, F.lit(False)) & F.coalesce(col(group) != monitor, F.lit(True))


def yymm(c: str | Column) -> Column:
    return F.date_format(col(c), "yyMM")


def month_index(code: str | Column) -> Column:
    """``yy * 12 + mm - 1`` of a yyMM code; null where it isn't one."""
    good = col(code).rlike("^[0-9]{2}(0[1-9]|1[0-2])$")
    return F.when(good, F.substring(col(code), 1, 2).try_cast("int") * 12 + F.substring(col(code), 3, 2).try_cast("int") - 1)


def first_time(*candidates: str) -> Column:
    """The first time that is there."""
    return F.coalesce(*[F.col(c) for c in candidates])


def elapsed(start: str | Column, end: str | Column, unit: str) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / {"days": 86_400_000_000, "hours": 3_600_000_000, "minutes": 60_000_000}[unit]


def side(c: str | Column) -> Column:
    """LEFT by a last character 1, 3 or 5, RIGHT by 2, 4 or 6; else null."""
    last = F.right(col(c).cast("string"), F.lit(1))
    return F.when(last.isin(*"135"), "LEFT").when(last.isin(*"246"), "RIGHT")


def clean_text(c: str | Column) -> Column:
    """Commas as semicolons, double quotes as single ones, and tab, line feed, return and bell as blanks."""
    return F.translate(col(c), ',"\t\n\r\x07', ";'    ")


def safe_token(c: str | Column) -> Column:
    """For paths: each of nine reserved characters is an underscore; null or blank is UNKNOWN."""
    text = F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"^\s+|\s+$", "")
    return F.when(text == "", "UNKNOWN").otherwise(F.translate(text, '<>:"/\\|?*', "_" * 9))


def sanitize_identifier(c: str | Column) -> Column:
    """Without all but letters A-Z, digits and underscores, case kept; fails where nothing is left."""
    clean = F.regexp_replace(col(c).cast("string"), "[^A-Za-z0-9_]", "")
    return F.when(clean == "", F.raise_error(F.concat(F.lit("no identifier in: "), col(c).cast("string"))).cast("string")).otherwise(clean)


def image_path(root: str, *, entity: str, klass: str, short: dict[str, str], ambiguous: Sequence[str], time: str, lot: str, unit: str, layer: str, point: str, image: str, file: str, ambiguous_folder: str = "AMBIGUOUS") -> Column:
    """``root/entity/yymmdd_hhmm_lot_unit_class_layer_point_image.ext``; ambiguous classes in ``root/folder/class/entity``.

    A missing time is ``000000_0000``; of a unit's name of 8 characters or more the sixth to eighth are used; the class is
    abbreviated; a missing point or image is 0; the extension is the file's in lower case, ``.jpg`` without a file.
    """
    raw_class = safe_token(klass)
    name = raw_class
    for long, s in short.items():
        name = F.when(raw_class == long, F.lit(s)).otherwise(name)
    stamp = F.coalesce(F.date_format(time, "yyMMdd_HHmm"), F.lit("000000_0000"))
    whole = F.trim(F.coalesce(F.col(unit).cast("string"), F.lit("")))
    few = safe_token(F.when(F.length(whole) >= 8, F.substring(whole, 6, 3)).otherwise(whole))
    number = lambda c: F.coalesce(F.col(c).cast("double").cast("long"), F.lit(0)).cast("string")
    spec = F.coalesce(F.col(file), F.lit(""))
    ext = F.when(spec == "", ".jpg").otherwise(F.lower(F.regexp_extract(spec, r"[^/.][^/]*?([.][^./]*)$", 1)))
    base = F.concat(F.concat_ws("_", stamp, safe_token(lot), few, name, safe_token(layer), number(point), number(image)), ext)
    folder = F.when(raw_class.isin(list(ambiguous)), F.concat_ws("/", F.lit(ambiguous_folder), raw_class, safe_token(entity))).otherwise(safe_token(entity))
    return F.concat_ws("/", F.lit(root), folder, base)


def parse_path(path: str | Column) -> Column:
    """Folder, time, point and image of a path that ``image_path`` makes; nulls where it doesn't match, and for the stand-in time."""
    pattern = r"([^/]+)/([0-9]{6}_[0-9]{4})_[^/]*_([0-9]+)_([0-9]+)([.][^./]*)?$"
    part = lambda k: F.nullif(F.regexp_extract(col(path), pattern, k), F.lit(""))
    return F.struct(part(1).alias("folder"), F.try_to_timestamp(part(2), F.lit("yyMMdd_HHmm")).alias("time"), part(3).try_cast("long").alias("point"), part(4).try_cast("int").alias("image"))


def image_ids(count: str | Column, base: Sequence[int], most: int = 16) -> Column:
    """Base ids, moved up where more than ``most`` images exist."""
    return F.transform(F.array(*[F.lit(b) for b in base]), lambda x: (x + F.greatest(F.lit(0), col(count) - most)).cast("int"))


def element_label(values: dict[str, str]) -> Column:
    """Symbols of positive values in falling order (ties by falling symbol), then the values rounded half-even: ``SiC - (99,1)``; nothing positive is empty."""
    items = F.array(*[F.struct(F.col(c).cast("double").alias("v"), F.lit(s).alias("s")) for c, s in values.items()])
    kept = F.sort_array(F.filter(items, lambda x: x["v"] > 0), asc=False)
    names = F.array_join(F.transform(kept, lambda x: x["s"]), "")
    numbers = F.array_join(F.transform(kept, lambda x: F.bround(x["v"], 0).cast("long").cast("string")), ",")
    return F.when(F.size(kept) > 0, F.concat(names, F.lit(" - ("), numbers, F.lit(")"))).otherwise("")


def first_nonblank(*columns: str, default: str = "UNKNOWN") -> Column:
    """The first text that isn't blank or ``nan``, else ``default``."""
    good = [F.when(~F.lower(F.trim(F.col(c).cast("string"))).isin("", "nan"), F.trim(F.col(c).cast("string"))) for c in columns]
    return F.coalesce(*good, F.lit(default))


def scaled(c: str | Column, centre: str | Column, unit: float) -> Column:
    """Distance from a centre in another unit."""
    return (col(c) - col(centre)) / unit


def marker(c: str | Column, marks: dict[str, str], other: str) -> Column:
    """A label by exact value."""
    out = F.when(F.lit(False), "")
    for k, v in marks.items():
        out = out.when(col(c) == k, v)
    return out.otherwise(other)


def event_time(end: str, start: str) -> Column:
    return F.coalesce(F.col(end), F.col(start))


def norm_recipe(c: str | Column) -> Column:
    return F.upper(F.trim(F.coalesce(col(c), F.lit(""))))


def to_number(c: str | Column) -> Column:
    return col(c).cast("string").try_cast("double")


def to_time(c: str | Column) -> Column:
    return F.try_to_timestamp(col(c).cast("string"))

"""Secret scans with DataFrame and SQL functions only: fixed patterns, and a battery of randomness tests.

A long token is scored over the alphabet of its inferred encoding (hex, base32 or base64):

- chi-squared uniformity of its letters, by the Wilson-Hilferty normal approximation;
- the runs test on letters above and below the middle of the alphabet;
- first-order serial correlation of letter positions.

A token passes the battery if none of the three rejects randomness (Bonferroni at ``BATTERY``). Short
natural tokens pass by luck more often than long ones, so each token also has a p-value under "natural
text", from two statistics that are added as normal ones: the chi-squared statistic, which then centres at
``(k - 1) + n * excess`` and grows with the length n, and the number of runs of one kind of letter (capitals, small
letters, digits, signs), which words keep long: a natural token changes its kind at ``CHANGES`` of its places
at most, a random one of base64 at six in ten. The p-values are held to a false discovery rate of ``RATE`` by Benjamini-Hochberg within each
encoding and length class (powers of two), over the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.llm._spark import Scratch, written

KINDS = ("assign", "access", "hex", "random")

# The base patterns. A whole match of hex or access has its least length in the pattern, which finds the same maximal runs;
# assign matches are taken first and dropped afterwards, since a dropped one still covers what follows it.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_ASSIGNED = 8

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: How much more often than under uniform letters two letters of a natural token agree.
EXCESS = {"hex": 1.0, "base32": 1.0, "base64": 2.0}
#: How often neighbouring letters of a natural token differ in kind.
CHANGES = {"hex": 0.15, "base32": 0.1, "base64": 0.3}
BATTERY, RATE = 1e-3, 0.01
#: Letters that a token has at least without its padding, and items that are put into one array at a time.
LEAST_BODY, BLOCK = 16, 128
#: p-values are rounded up to steps of this many parts of a natural logarithm, up to the last step.
STEPS, LAST_STEP = 10, 1000

_SPAN = "array<struct<start:int,end:int,token:string>>"
_CANDIDATES = "array<struct<start:int,end:int,stratum:string,step:int>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _running(items: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What ``step(position, item)`` gives along an array, nulls left out; it returns the next position too, from 0 on.

    Arrays are extended by copying, so this goes in blocks of ``BLOCK``: the cost of n items is n * BLOCK and not n * n.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def inner(have: Column, x: Column) -> Column:
        pos, out = step(have["pos"], x)
        return F.struct(pos.cast("int").alias("pos"), F.when(out.isNotNull(), F.concat(have["out"], F.array(out))).otherwise(have["out"]).alias("out"))

    def outer(have: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(have["pos"].alias("pos"), none.alias("out")), inner)
        return _bound(done, lambda r: F.struct(r["pos"].alias("pos"), F.concat(have["out"], F.array(r["out"])).alias("out")))

    def run(whole: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / BLOCK).cast("int")), lambda k: F.slice(whole, k * BLOCK + 1, BLOCK))
        zero = F.struct(F.lit(0).alias("pos"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("out"))
        return F.flatten(F.aggregate(blocks, zero, outer, lambda have: have["out"]))

    return _bound(items, lambda whole: F.when(F.size(whole) > 0, run(whole)).otherwise(none))


def _spans(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """``start, end, token`` of each match, in code points: the gaps between matches give their places."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, F.length)
    at = F.arrays_zip(found.alias("token"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"), gaps.alias("gap"), sizes.alias("size"))

    def step(pos: Column, x: Column) -> tuple[Column, Column]:
        begin = pos + x["gap"]
        end = begin + F.coalesce(x["size"], F.lit(0))
        span = F.struct(begin.cast("int").alias("start"), end.cast("int").alias("end"), x["token"].alias("token"))
        return end, F.when(x["token"].isNotNull() & (F.length(x["part"]) >= least), span)

    return F.when(text.rlike(pattern), _running(at, "struct<start:int,end:int,token:string>", step)).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def _upper_tail(z: str) -> str:
    """1 - Phi(z) for z >= 0: a polynomial by Abramowitz and Stegun (26.2.17), beyond 3 the asymptotic series."""
    t = f"(1D / (1D + 0.2316419D * ({z})))"
    poly = f"{t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D))))"
    density = f"(exp(-({z}) * ({z}) / 2D) / {math.sqrt(2 * math.pi)!r}D)"
    return f"CASE WHEN ({z}) < 3D THEN {density} * {poly} ELSE {density} / ({z}) * (1D - 1D / (({z}) * ({z})) + 3D / pow({z}, 4)) END"


def _tail(z: str) -> str:
    return f"CASE WHEN ({z}) >= 0D THEN {_upper_tail(f'({z})')} ELSE 1D - ({_upper_tail(f'(-({z}))')}) END"


def _battery(spans: str) -> str:
    """SQL from an array column of token spans to those with stratum and step; step is -1 where the battery rejects randomness."""
    encoding = "CASE WHEN body RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN 'hex' WHEN body RLIKE '^[A-Z2-7]+$' THEN 'base32' ELSE 'base64' END"
    alphabet = "CASE encoding " + " ".join(f"WHEN '{e}' THEN '{a}'" for e, a in ALPHABETS.items()) + " END"
    excess = "CASE encoding " + " ".join(f"WHEN '{e}' THEN {x}D" for e, x in EXCESS.items()) + " END"
    rate = "CASE f.encoding " + " ".join(f"WHEN '{e}' THEN {x}D" for e, x in CHANGES.items()) + " END"

    def each(inner: str, var: str, out: str) -> str:
        return f"transform({inner}, {var} -> {out})"

    base = "'start', {v}.start, 'end', {v}.end"
    one = each(f"filter({spans}, x -> length(rtrim('=', x.token)) >= {LEAST_BODY})", "a", f"named_struct({base.format(v='a')}, 'body', rtrim('=', a.token))")
    two = each(one, "b", f"named_struct({base.format(v='b')}, 'body', b.body, 'encoding', {encoding.replace('body', 'b.body')})")
    spelled = "CASE c.encoding WHEN 'hex' THEN lower(c.body) WHEN 'base32' THEN c.body ELSE translate(c.body, '-_=', '+/A') END"
    half = each(two, "c", f"named_struct({base.format(v='c')}, 'encoding', c.encoding, 'text', {spelled}, 'letters', {alphabet.replace('encoding', 'c.encoding')}, 'excess', {excess.replace('encoding', 'c.encoding')})")
    # Every step is linear in the token: letters are cut once, counts are differences of lengths.
    numbers = "transform(slice(split(h.text, ''), 1, length(h.text)), x -> instr(h.letters, x) - 1)"
    squares = "aggregate(split(h.letters, ''), 0D, (s, x) -> s + pow(length(h.text) - length(replace(h.text, x, '')), 2))"
    changes = "cast(regexp_count(h.text, '[A-Z]+|[a-z]+|[0-9]+|[+/]+') - 1 AS DOUBLE)"
    three = each(half, "h", f"named_struct({base.format(v='h')}, 'encoding', h.encoding, 'n', cast(length(h.text) AS DOUBLE), 'k', cast(length(h.letters) AS DOUBLE), 'excess', h.excess, 'v', {numbers}, 'squares', {squares}, 'changes', {changes})")
    high = "size(filter(d.v, y -> y >= d.k / 2))"
    runs = "1 + size(filter(sequence(1, size(d.v) - 1), i -> (d.v[i] >= d.k / 2) <> (d.v[i - 1] >= d.k / 2)))"
    mean = "aggregate(d.v, 0D, (h, x) -> h + x) / d.n"
    four = each(three, "d", f"named_struct({base.format(v='d')}, 'encoding', d.encoding, 'n', d.n, 'k', d.k, 'excess', d.excess, 'v', d.v, 'changes', d.changes, 'chi', d.k / d.n * d.squares - d.n, 'n1', cast({high} AS DOUBLE), 'runs', cast({runs} AS DOUBLE), 'mean', {mean})")
    spread = "aggregate(e.v, 0D, (h, x) -> h + (x - e.mean) * (x - e.mean))"
    lagged = "aggregate(sequence(1, size(e.v) - 1), 0D, (h, i) -> h + (e.v[i] - e.mean) * (e.v[i - 1] - e.mean))"
    five = each(four, "e", f"named_struct({base.format(v='e')}, 'encoding', e.encoding, 'n', e.n, 'k', e.k, 'excess', e.excess, 'changes', e.changes, 'chi', e.chi, 'n1', e.n1, 'runs', e.runs, 'mu', 2D * e.n1 * (e.n - e.n1) / e.n + 1D, 'r', CASE WHEN {spread} > 0D THEN {lagged} / {spread} ELSE 1D END)")
    z_uniform = "(pow(greatest(f.chi, 1e-9D) / (f.k - 1D), 1D / 3D) - (1D - 2D / (9D * (f.k - 1D)))) / sqrt(2D / (9D * (f.k - 1D)))"
    z_runs = "CASE WHEN f.n1 < 2D OR f.n - f.n1 < 2D THEN 99D ELSE abs(f.runs - f.mu) / sqrt((f.mu - 1D) * (f.mu - 2D) / (f.n - 1D)) END"
    z_serial = "abs(f.r + 1D / f.n) * sqrt(f.n)"
    z_letters = "((f.k - 1D) + f.n * f.excess - f.chi) / sqrt(2D * (f.k - 1D) + 4D * f.n * f.excess)"
    z_kinds = f"(f.changes - (f.n - 1D) * ({rate})) / sqrt((f.n - 1D) * ({rate}) * (1D - ({rate})))"
    z_natural = f"({z_letters} + {z_kinds}) / sqrt(2D)"
    six = each(five, "f", f"named_struct({base.format(v='f')}, 'stratum', concat(f.encoding, ':', cast(cast(floor(log2(f.n)) AS INT) AS STRING)), 'zu', {z_uniform}, 'zr', {z_runs}, 'zs', {z_serial}, 'zn', {z_natural})")
    random = f"least({_tail('g.zu')}, 2D * ({_upper_tail('g.zr')}), 2D * ({_upper_tail('g.zs')}))"
    step = f"cast(least({LAST_STEP}D, floor({STEPS}D * -ln(greatest(1e-300D, {_tail('g.zn')})))) AS INT)"
    return each(six, "g", f"named_struct({base.format(v='g')}, 'stratum', g.stratum, 'step', CASE WHEN {random} * 3D < {BATTERY}D THEN -1 ELSE {step} END)")


def secret_spans(docs: DataFrame, *, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, assign, access, hex, random`` of every whole text: arrays of ``start, end`` in code points, end exclusive.

    One pass over the texts; what it keeps of each row (spans only) is written once and read twice,
    for the table of p-values and for the result. That table has a row per encoding, length class and
    step, so at most a few thousand whatever the corpus; its thresholds, one per stratum, are the only
    thing brought to the driver.

    Null and empty texts have no spans; rows with null or repeated ids each keep their own; an empty
    table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = rows.select("id", _spans(text, ASSIGN, 2, LEAST_ASSIGNED).alias("assign"), _spans(text, ACCESS).alias("access"), _spans(text, HEX).alias("hex"), _spans(text, CANDIDATE).alias("long"))
    slim = [F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(c) for c in ("assign", "access", "hex")]
    scored = F.when(F.size("long") > 0, F.expr(_battery("long"))).otherwise(F.expr(f"cast(array() as {_CANDIDATES})"))
    kept = written(found.select("id", *slim, scored.alias("long")), "secrets")
    cut = _thresholds(kept, rate)
    return kept.select(F.col("id").alias(id_col), "assign", "access", "hex", F.transform(F.filter("long", lambda x: _beyond(x, cut)), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("random"))


def _thresholds(kept: DataFrame, rate: float) -> dict[str, int]:
    """Of each stratum the least step from which on p-values are discoveries at ``rate``."""
    counted = kept.select(F.explode("long").alias("x")).groupBy(F.col("x.stratum").alias("stratum"), F.col("x.step").alias("step")).count().collect()
    cut: dict[str, int] = {}
    for stratum in {r.stratum for r in counted}:
        own = sorted(((r.step, r["count"]) for r in counted if r.stratum == stratum), reverse=True)
        total, seen = sum(n for _, n in own), 0
        for step, n in own:
            seen += n
            if step >= 0 and math.exp(-step / STEPS) * total / seen <= rate:
                cut[stratum] = step
    return cut


def _beyond(x: Column, cut: dict[str, int]) -> Column:
    out = F.lit(False)
    for stratum, step in sorted(cut.items()):
        out = out | ((x["stratum"] == stratum) & (x["step"] >= step))
    return out


def written_spans(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, by start and then kind as listed, comma-joined."""

    def tagged_as(rank: int, kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    tagged = [tagged_as(i, k) for i, k in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*tagged)), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def mask_secrets(docs: DataFrame, *, mark: str = "[SECRET]", rate: float = RATE, text_col: str = "text") -> DataFrame:
    """``docs`` with all columns, every base span of its texts replaced by ``mark``, and tokens the battery finds too.

    Texts are changed in place by the patterns themselves; tokens found by the battery are those that
    passed at the thresholds of the whole table, so the table is scanned once for these beforehand. Spans that overlap
    are masked as one. Null and empty texts stay as they are, repeated and null ids don't matter, an empty table gives no
    rows, and no column name clashes: a row travels as one struct.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    scored = docs.where(text.rlike(CANDIDATE)).select(_spans(text, CANDIDATE).alias("long"))
    scratch = Scratch(docs.sparkSession)
    cut = _thresholds(scratch.write(scored.select(F.expr(_battery("long")).alias("long")), "secrets"), rate)
    scratch.drop(*[t for t, _ in scratch.held])
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    own = F.coalesce(F.col("doc").getField(text_col), F.lit(""))
    work = row.select("doc", own.alias("own"), _spans(own, CANDIDATE).alias("tokens"))
    work = work.select("doc", "own", F.when(F.size("tokens") > 0, F.expr(_battery("tokens"))).otherwise(F.expr(f"cast(array() as {_CANDIDATES})")).alias("scored"))
    own = F.col("own")
    found = (_spans(own, ASSIGN, 2, LEAST_ASSIGNED), _spans(own, ACCESS), _spans(own, HEX), F.filter("scored", lambda x: _beyond(x, cut)))
    spans = F.array_sort(F.concat(*[F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for s in found]))

    def step(pos: Column, x: Column) -> tuple[Column, Column]:
        before = F.concat(F.substring(own, pos + 1, x["start"] - pos), F.lit(mark))
        return F.greatest(pos, x["end"]), F.when(x["start"] >= pos, before)

    last = F.array_max(F.transform("spans", lambda x: x["end"]))
    masked = F.concat(F.array_join(_running(F.col("spans"), "string", step), ""), F.substring(own, last + 1, F.length(own)))
    done = work.select("doc", "own", spans.alias("spans")).select("doc", F.when(F.size("spans") > 0, masked).alias("masked"))
    text = F.coalesce("masked", F.col("doc").getField(text_col))
    return done.select(*[(text if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns])

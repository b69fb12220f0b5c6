"""Secret scans with DataFrame functions only.

Three fixed patterns give the base spans. Beside them, candidate strings are runs of key characters with
both letters and digits; each gets a character class (hexadecimal digits, letters and digits, or base64
signs too), and a window of 20 characters slides over it. The window's Shannon entropy follows from counts
that change by one character in and one out per step: with S the sum of c log2 c, it is log2 20 - S / 20.
Windows at or above the class's threshold make one span from the first to the last of them, unless the
candidate is on the allow-list or overlaps a base span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three base patterns, the least length of what each must hold, and their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates begin where no key character stands before them.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"

WINDOW = 20
#: Bits a character that a window must reach, by class. Random strings lie near 3.4, 4.1 and 4.1.
THRESHOLDS = {"^[0-9a-fA-F]+$": 3.0, "^[A-Za-z0-9]+$": 3.75}
OTHER_THRESHOLD = 3.9

#: Known harmless shapes: UUIDs, placeholders, counted-out alphabets, paths, dates with times. No group is
#: repeated: the pattern engine would go one call deeper each time, and a long path would end the executor.
ALLOWED = (
    r"(?i)^([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|.*(example|placeholder|changeme|dummy|sample|"
    r"xxxxxx|000000|123456789|abcdefgh|abcdef0123).*|(?!.*//)[a-z_-]+/[a-z_/-]*/[a-z0-9_-]*|[0-9]{4}-[0-9]{2}-[0-9]{2}.*)$"
)

#: Matches of one text are placed in groups of this many, so that long lists stay cheap.
GROUP = 256

REDACTED = "[SECRET]"

#: Codes of printable characters start here.
_FIRST_CODE, _CODES = 33, 94

_SPAN = "struct<start: bigint, `end`: bigint, hit: string, held: string>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _placed(text: str, pattern: str, held: int = 0) -> Column:
    """All matches from the left as spans in code points, with the match and one of its groups.

    What lies between two matches comes from the same pattern's split; running sums of both kinds of
    lengths give the places.
    """
    p = _quoted(pattern)
    between = f"split({text}, {p}, -1)"
    hits = f"zip_with(regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {held}), (h, k) -> struct(h as hit, k as held))"
    # The piece behind the last match has none of its own and falls out.
    zipped = f"zip_with({hits}, {between}, (m, g) -> struct(cast(length(g) as bigint) as gap, m.hit as hit, m.held as held))"
    return F.expr(f"CASE WHEN {text} rlike {p} THEN filter({zipped}, x -> x.hit IS NOT NULL) END")


def _spans(matches: str) -> Column:
    """Spans of the matches that ``_placed`` found: running sums within groups, and over the groups."""
    step = "cast(length(x.hit) as bigint)"
    groups = f"transform(sequence(0, (size({matches}) - 1) div {GROUP}), b -> slice({matches}, b * {GROUP} + 1, {GROUP}))"
    total = f"aggregate(g, cast(0 as bigint), (n, x) -> n + x.gap + {step})"
    begun = f"""aggregate(transform({groups}, g -> {total}), array(cast(0 as bigint)), (list, n) -> array_append(list, element_at(list, -1) + n))"""
    placed = f"""aggregate(g, struct(s as at, cast(array() as array<{_SPAN}>) as list),
        (acc, x) -> struct(acc.at + x.gap + {step} as at, array_append(acc.list,
            struct(acc.at + x.gap as start, acc.at + x.gap + {step} as `end`, x.hit as hit, x.held as held)) as list), acc -> acc.list)"""
    return F.expr(
        f"""CASE WHEN size({matches}) > 0 THEN flatten(zip_with({groups}, slice({begun}, 1, (size({matches}) - 1) div {GROUP} + 1),
            (g, s) -> {placed})) ELSE cast(array() as array<{_SPAN}>) END"""
    )


def _surprising(candidate: str) -> str:
    """The places (from, to) in a candidate that its windows of high entropy cover, or null."""
    levels = ", ".join(f"cast({0 if c == 0 else c * math.log2(c)!r} as double)" for c in range(WINDOW + 2))
    cases = " ".join(f"WHEN {candidate}.hit rlike {_quoted(p)} THEN {t}" for p, t in THRESHOLDS.items())
    limit = f"cast(CASE {cases} ELSE {OTHER_THRESHOLD} END as double)"
    f = f"array({levels})"
    code = f"(ascii({{}}) - {_FIRST_CODE})"
    into, out = code.format("chars[i]"), code.format(f"chars[i - {WINDOW}]")
    # One step: a character leaves (once the window is full), one enters, and the sum follows.
    left = f"IF(i >= {WINDOW}, transform(acc.counts, (c, j) -> IF(j = {out}, c - 1, c)), acc.counts)"
    sum_left = f"acc.total + IF(i >= {WINDOW}, {f}[acc.counts[{out}] - 1] - {f}[acc.counts[{out}]], cast(0 as double))"
    step = f"""aggregate(array(struct({left} as counts, {sum_left} as total)), acc, (a, m) -> struct(
        transform(m.counts, (c, j) -> IF(j = {into}, c + 1, c)) as counts,
        m.total + {f}[m.counts[{into}] + 1] - {f}[m.counts[{into}]] as total, a.first as first, a.last as last, a.level as level))"""
    high = f"i >= {WINDOW - 1} AND {math.log2(WINDOW)!r} - s.total / {WINDOW} >= s.level - 1e-9"
    marked = f"""aggregate(array({step}), acc, (b, s) -> struct(s.counts as counts, s.total as total,
        IF({high}, coalesce(s.first, i - {WINDOW - 1}), s.first) as first, IF({high}, i + 1, s.last) as last, s.level as level))"""
    start = f"""struct(array_repeat(0, {_CODES}) as counts, cast(0 as double) as total, cast(null as int) as first,
        cast(null as int) as last, {limit} as level)"""
    return f"""aggregate(array(split({candidate}.hit, '')), cast(null as struct<first: int, last: int>), (none, chars) ->
        aggregate(sequence(0, size(chars) - 1), {start}, (acc, i) -> {marked}, acc -> struct(acc.first as first, acc.last as last)))"""


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``secret_spans``: ``start, kind, end`` ordered by start, kind and end.

    ``kind`` counts 0 assign, 1 access, 2 hex, 3 entropy; places are code points, the end excluded.
    Only ``text`` is read: null counts as empty and has no spans, other columns stay as they are
    (one called ``secret_spans`` is replaced). No shuffle, no Python; a long text is scanned whole.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "secret_spans"]
    named = docs.select(F.struct(*kept).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    found = named.select(
        "row",
        _placed("t", ASSIGN, 2).alias("m0"),
        F.when(F.contains("t", F.lit("AKIA")), _placed("t", ACCESS)).alias("m1"),
        _placed("t", HEX).alias("m2"),
        _placed("t", CANDIDATE).alias("m3"),
    )
    places = found.select("row", *(_spans(f"m{i}").alias(f"s{i}") for i in range(4)))
    base = places.select(
        "row",
        "s3",
        F.expr(
            f"""concat(
                transform(filter(s0, x -> length(x.held) >= {ASSIGN_LEAST}), x -> struct(x.start as start, 0 as kind, x.`end` as `end`)),
                transform(s1, x -> struct(x.start as start, 1 as kind, x.`end` as `end`)),
                transform(s2, x -> struct(x.start as start, 2 as kind, x.`end` as `end`)))"""
        ).alias("base"),
    )
    candidates = base.select(
        "row",
        "base",
        F.expr(f"filter(s3, c -> NOT c.hit rlike {_quoted(ALLOWED)})").alias("c"),
    )
    windows = candidates.select("row", "base", F.expr(f"transform(c, x -> struct(x.start as at, {_surprising('x')} as w))").alias("w"))
    more = "transform(filter(w, x -> x.w.first IS NOT NULL), x -> struct(x.at + x.w.first as start, 3 as kind, x.at + x.w.last as `end`))"
    # What a base span covers whole is told already; what goes beyond one is a secret that it leaves in the text.
    own = f"filter({more}, x -> NOT exists(base, b -> b.start <= x.start AND x.`end` <= b.`end`))"
    spans = windows.select("row", F.expr(f"array_sort(concat(base, {own}))").alias("secret_spans"))
    return spans.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "secret_spans"), "secret_spans")


def written(spans: str, kinds: int = len(KINDS)) -> Column:
    """Spans of the first ``kinds`` kinds as ``kind:start:end``, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform(filter({spans}, x -> x.kind < {kinds}), x -> concat_ws(':', array({names})[x.kind], x.start, x.`end`)), ',')")


def redacted(text: str, spans: str) -> Column:
    """The text with every span, overlapping ones together, replaced by a mark."""
    merged = f"""aggregate({spans}, cast(array() as array<struct<s: bigint, e: bigint>>), (list, x) ->
        IF(size(list) > 0 AND element_at(list, -1).e > x.start,
            concat(slice(list, 1, size(list) - 1), array(struct(element_at(list, -1).s as s, greatest(element_at(list, -1).e, x.`end`) as e))),
            array_append(list, struct(x.start as s, x.`end` as e))))"""
    left = f"""aggregate({merged}, struct(cast(0 as bigint) as at, cast(array() as array<string>) as parts),
        (acc, x) -> struct(x.e as at, array_append(acc.parts, substring({text}, cast(acc.at + 1 as int), cast(x.s - acc.at as int))) as parts),
        acc -> array_append(acc.parts, substring({text}, cast(acc.at + 1 as int))))"""
    return F.expr(f"CASE WHEN size({spans}) > 0 THEN array_join({left}, '{REDACTED}') ELSE {text} END")

"""Secret scans: certain secrets by pattern, and weak candidates that only count beside their complement.

A credential often comes in parts: an identifier, a secret, an endpoint. Keyed assignments, access keys and long
hexadecimal numbers are reported wherever they stand. A bare token that looks random, a named identifier or a service address is
reported only when the parts that complete it lie within reach: the intervals of the parts of a text are joined by their
distance. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import stored

# Kinds in the order of equal starts, and their patterns. Case is spelt out, so that it means the same
# everywhere.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a run of 16 or more characters: shorter ones would fail, and longer runs are taken whole
HEX = r"[0-9a-f]{32,}"
NAMED = r"([Cc]lient|[Aa]ccount|[Uu]ser|[Aa]ccess|[Aa]pp)[_-]?([Ii]d|[Kk]ey|[Nn]ame|ID)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@._-]+)"
BARE = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"[a-z][a-z0-9+.-]*://[^\x00-\x20\"'<>]+"
KINDS = ("assign", "access", "hex", "named", "bare", "endpoint")
LEAST_VALUE = 8
REACH = 200  # code points between two parts of one credential

# Texts of more bytes are taken apart into rows: arrays are built up and compared within a text, which is quadratic in the
# number of its spans.
LONG = 16_384

SPAN = "array<struct<start:int,end:int,rank:int>>"


def _spans(text: Column, pattern: str, rank: int, least: Column | None = None) -> Column:
    """Spans of all matches of a pattern, leftmost and not overlapping, in code points.

    The text between matches and the matches themselves alternate, so their lengths add up to the positions.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"), (least if least is not None else found).alias("value"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"))
        keep = (F.length(part["value"]) >= LEAST_VALUE) if least is not None else F.lit(True)
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda s: s["out"])).otherwise(F.array().cast(SPAN))


def _base(text: Column) -> Column:
    """The certain spans of a text, sorted by start, then kind."""
    assign = _spans(text, ASSIGN, 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    return F.array_sort(F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2)), _in_order)


def _in_order(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["rank"] - b["rank"])


def _weak(text: Column, base: Column) -> Column:
    """Weak candidates that no certain span overlaps. A bare token must hold a letter and a digit."""
    bare = F.filter(_spans(text, BARE, 4), lambda s: _slice(text, s).rlike("[0-9]") & _slice(text, s).rlike("[A-Za-z]"))
    found = F.concat(_spans(text, NAMED, 3), bare, _spans(text, ENDPOINT, 5))
    return F.filter(found, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))


def _slice(text: Column, span: Column) -> Column:
    return F.substring(text, span["start"] + 1, span["end"] - span["start"])


def _linked(parts: DataFrame) -> DataFrame:
    """``(row, extra)``: for rows with parts (``row``, ``start``, ``end``, ``rank``), the weak ones with their complement
    within reach.

    All parts of a text in the order of their starts: the latest end among identifiers that start before, and the
    earliest start among those after, say whether any lies within reach; likewise for secrets. A window over the parts
    of one text therefore does the interval join without making pairs.
    """
    # What follows is what comes before in the opposite order: a frame up to the end would be gone through for each row.
    of_text, first = Window.partitionBy("row"), (Window.unboundedPreceding, 0)
    before = of_text.orderBy("start", "end", "rank").rowsBetween(*first)
    after = of_text.orderBy(F.desc("start"), F.desc("end"), F.desc("rank")).rowsBetween(*first)

    def near(*ranks: int) -> Column:
        own = F.col("rank").isin(*ranks)
        latest, earliest = F.max(F.when(own, F.col("end"))).over(before), F.min(F.when(own, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - latest <= REACH, F.lit(False)) | F.coalesce(earliest - F.col("end") <= REACH, F.lit(False))

    beside = parts.withColumn("by_id", near(1, 3)).withColumn("by_secret", near(0, 2, 4))
    kept = beside.filter(
        ((F.col("rank") == 3) & F.col("by_secret")) | ((F.col("rank") == 4) & F.col("by_id")) | ((F.col("rank") == 5) & F.col("by_id") & F.col("by_secret"))
    )
    return kept.groupBy("row").agg(F.collect_list(F.struct("start", "end", "rank")).alias("extra"))


def _parts(rows: DataFrame) -> DataFrame:
    """``(row, start, end, rank)``: certain spans, and weak ones that no certain span overlaps, of texts (``row``, ``text``).

    The same as ``_base`` and ``_weak`` with a row a match: running sums of lengths give the positions, and the latest end and
    earliest start of certain spans around a weak one say whether any overlaps it.
    """
    patterns = (ASSIGN, ACCESS, HEX, NAMED, BARE, ENDPOINT)
    found = []
    for rank, pattern in enumerate(patterns):
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all("text", F.lit(pattern), F.lit(2)) if rank == 0 else hits
        zipped = F.arrays_zip(F.slice(F.split("text", pattern, -1), 1, F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value"))
        own = rows.filter(F.col("text").rlike(pattern)).select("row", F.lit(rank).alias("rank"), F.posexplode(zipped).alias("i", "part"))
        sizes = F.length("part.gap").alias("gap"), F.length("part.hit").alias("size"), F.length("part.value").alias("value")
        mixed = F.col("part.hit").rlike("[0-9]") & F.col("part.hit").rlike("[A-Za-z]")
        found.append(own.select("row", "rank", "i", *sizes, mixed.alias("mixed")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    upto = Window.partitionBy("row", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto).cast("int")
    placed = every.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    placed = placed.filter(F.when(F.col("rank") == 0, F.col("value") >= LEAST_VALUE).when(F.col("rank") == 4, F.col("mixed")).otherwise(True))
    of_text, first, sure = Window.partitionBy("row"), (Window.unboundedPreceding, 0), F.col("rank") < 3
    latest = F.max(F.when(sure, F.col("end"))).over(of_text.orderBy("start").rangeBetween(*first))
    earliest = F.min(F.when(sure, F.col("start"))).over(of_text.orderBy(F.desc("start")).rangeBetween(*first))
    overlapped = F.coalesce(latest > F.col("start"), F.lit(False)) | F.coalesce(earliest < F.col("end"), F.lit(False))
    return placed.withColumn("gone", ~sure & overlapped).filter("NOT gone").select("row", "start", "end", "rank")


def _scan_long(rows: DataFrame, whole: Column) -> DataFrame:
    """``(doc, base, spans)`` of long texts, with a row a match on the way."""
    held = stored(rows.select("doc", whole.alias("text"), F.monotonically_increasing_id().alias("row")), "long")
    parts = stored(_parts(held.select("row", "text")), "long-parts")
    span = F.struct("start", "end", "rank")
    base = parts.groupBy("row").agg(F.collect_list(F.when(F.col("rank") < 3, span)).alias("base"))
    found = held.select("doc", "row").join(base, "row", "left").join(_linked(parts), "row", "left")
    none = F.array().cast(SPAN)
    found = found.select("doc", F.array_sort(F.coalesce("base", none), _in_order).alias("base"), F.coalesce("extra", none).alias("extra"))
    return found.select("doc", "base", F.array_sort(F.concat("base", "extra"), _in_order).alias("spans"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc, base, spans)`` for every row of ``docs``: the row as a struct, its certain spans, and all spans.

    A span has ``start``, ``end`` (code points, end exclusive) and ``rank``, the place of its kind in ``KINDS``; spans are
    sorted by start, then kind. Null and empty texts have none. Repeated rows come out as often as they come in; an
    empty table gives an empty one. No column name of ``docs`` can clash.

    A weak candidate needs an identifier beside it, so only texts with one are linked; they are written to the shared
    folder first, which fixes their row numbers. All others are done where they are read. Texts of more than ``LONG`` bytes
    are taken apart into a row a match, so that a text of any number of secrets takes a time in proportion to it.
    """
    whole = F.coalesce(F.col("doc")[text], F.lit(""))
    every = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"))
    rows, long = every.filter(F.octet_length(whole) <= LONG), every.filter(F.octet_length(whole) > LONG)
    identified = whole.contains("AKIA") | whole.rlike(NAMED)
    plain = rows.filter(~identified).select("doc", _base(whole).alias("base"))
    parted = rows.filter(identified).select("doc", _base(whole).alias("base"))
    parted = parted.select("doc", "base", _weak(whole, F.col("base")).alias("weak"), F.monotonically_increasing_id().alias("row"))
    parted = stored(parted, "parted")
    parts = parted.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*")
    linked = parted.join(_linked(parts), "row", "left")
    extra = F.coalesce("extra", F.array().cast(SPAN))
    linked = linked.select("doc", "base", F.array_sort(F.concat("base", extra), _in_order).alias("spans"))
    short = plain.select("doc", "base", F.col("base").alias("spans")).unionByName(linked)
    return short.unionByName(_scan_long(long, whole))


def count_of(spans: Column | str, kind: str) -> Column:
    """How many spans are of a kind."""
    rank = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank))


def shown(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by the kind of its first one in angle brackets."""

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        added = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, F.lit("<"), F.get(F.array(*map(F.lit, KINDS)), s["rank"]), F.lit(">")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), added.otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def sql_twin(table: str = "documents") -> str:
    """DuckDB text of the digest of ``scan``: counts and hash of the certain spans, and all spans as text."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    patterns = (ASSIGN, ACCESS, HEX, NAMED, BARE, ENDPOINT)
    found = " UNION ALL ".join(
        f"SELECT k, {r} AS rank, regexp_extract_all(t, {quoted(p)}, 0) AS hits, string_split_regex(t, {quoted(p)}) AS gaps, "
        f"regexp_extract_all(t, {quoted(p)}, {2 if r == 0 else 0}) AS vals FROM d WHERE regexp_matches(t, {quoted(p)})"
        for r, p in enumerate(patterns)
    )
    names = " ".join(f"WHEN {r} THEN '{name}'" for r, name in enumerate(KINDS))
    gap = "greatest(p.s - w.e, w.s - p.e)"

    def near(ranks: str) -> str:
        return f"EXISTS (SELECT 1 FROM parts p WHERE p.k = w.k AND p.rank IN ({ranks}) AND {gap} <= {REACH})"

    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM {table}),
found AS ({found}),
hits AS (SELECT k, rank, i, hits[i] AS hit, gaps[i] AS gap, vals[i] AS val
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found)),
placed AS (SELECT k, rank, hit, val, (sum(length(gap)) OVER (PARTITION BY k, rank ORDER BY i)
    + coalesce(sum(length(hit)) OVER (PARTITION BY k, rank ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s
    FROM hits),
spans AS (SELECT k, rank, s, s + length(hit) AS e, hit, val FROM placed),
base AS (SELECT k, rank, s, e FROM spans WHERE rank IN (1, 2) OR (rank = 0 AND length(val) >= {LEAST_VALUE})),
weak AS (SELECT k, rank, s, e FROM spans w WHERE rank >= 3
    AND (rank <> 4 OR (regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]')))
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.k = w.k AND b.s < w.e AND w.s < b.e)),
parts AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
kept AS (SELECT *, rank < 3 AS sure FROM base UNION ALL SELECT *, false FROM weak w
    WHERE (rank = 3 AND {near('0, 2, 4')}) OR (rank = 4 AND {near('1, 3')}) OR (rank = 5 AND {near('0, 2, 4')} AND {near('1, 3')})),
shown AS (SELECT *, CASE rank {names} END || ':' || s || ':' || e AS span FROM kept)
SELECT d.doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
    count(*) FILTER (WHERE rank = 2) AS n_hex,
    sha256(coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE sure), '')) AS base_sha256,
    coalesce(string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE span IS NOT NULL), '') AS spans
FROM d LEFT JOIN shown ON shown.k = d.k GROUP BY d.k, d.doc_id"""

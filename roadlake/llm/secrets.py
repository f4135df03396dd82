"""Secret scan over an incremental ledger of text blobs.

Every text is addressed by its SHA-256. A ledger (Parquet, append-only) holds one row per blob,
rule and rule version that has been scanned, with the spans found. A scan looks at each distinct
blob once, applies only the rule versions the ledger lacks for it, appends what it finds, and
joins the findings of the ledger back to every row that carries the blob.

Everything is DataFrame expressions. Positions come from cutting a text at the matches: the
lengths of the parts between and of the matches add up to the offsets, a stretch of matches at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadlake.llm.common import cut, free_name
from roadlake.session import scratch_path

LEDGER_SCHEMA = "blob binary, rule string, version int, spans array<struct<start:int,stop:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts when ``group`` of it has at least ``least`` characters.

    Raise ``version`` with every change of a rule: blobs are then scanned again for it.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


#: The base kinds, in the order in which spans with one start are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    # A run is matched to its end, so a length inside the pattern finds the runs that a filter would keep.
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further kinds, listed after the base ones.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES
#: A private key's first line with the base64 runs that follow it, and its last line. :func:`mask_secrets` pairs them by position.
#: Repetitions are possessive, which the matcher loops over; others it would recurse into.
KEY_BEGIN = Rule("key_begin", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:(?:\s|\\[nr])*+[A-Za-z0-9+/]{16,}+={0,2}+)*+")
KEY_END = Rule("key_end", r"-----END [A-Z ]{0,40}PRIVATE KEY-----")
#: What is masked: the kinds of ``RULES``, keys as a whole. (``RULES`` finds their first line, as the query's SQL does.)
MASKED_RULES = tuple(r for r in RULES if r.kind != "private_key") + (KEY_BEGIN, KEY_END)
#: Matches whose offsets are summed up together, and characters of a text that are masked together. Parameters of cost only.
AT_ONCE, STRETCH = 256, 1024


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, stop) in code points of a rule's leftmost, non-overlapping matches."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, 0)
    between = F.split(text, rule.pattern, -1)
    value = lambda match: F.regexp_extract(match, rule.pattern, rule.group)
    steps = F.zip_with(
        found,
        between,
        lambda match, gap: F.struct(
            F.length(gap).alias("gap"),
            F.length(match).alias("size"),
            (F.length(value(match)) >= rule.least if rule.group else F.length(match) >= rule.least).alias("counts"),
        ),
    )
    empty = F.expr("cast(array() as array<struct<start:int,stop:int>>)")
    ends = lambda parts: F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["size"]).alias("at"),
            F.when(
                s["counts"],
                F.concat(
                    acc["spans"],
                    F.array(F.struct((acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["size"]).alias("stop"))),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    # An array that grows is copied with every match, so it grows by a stretch of matches only; stretches are then moved to their places.
    # The list of one holds the matches, which an expression inside the inner function would look for again in every stretch.
    whole = F.array(F.filter(steps, lambda s: s["size"].isNotNull()))
    stretches = F.flatten(F.transform(whole, lambda all_: F.transform(
        F.sequence(F.lit(1), F.size(all_), F.lit(AT_ONCE)), lambda i: ends(F.slice(all_, i, AT_ONCE))
    )))
    moved = F.aggregate(
        stretches,
        F.struct(F.lit(0).alias("at"), F.array(empty).alias("spans")),
        lambda acc, part: F.struct(
            (acc["at"] + part["at"]).alias("at"),
            F.concat(acc["spans"], F.array(F.transform(part["spans"], lambda s: F.struct(
                (acc["at"] + s["start"]).alias("start"), (acc["at"] + s["stop"]).alias("stop")
            )))).alias("spans"),
        ),
        lambda acc: F.flatten(acc["spans"]),
    )
    return F.when(F.rlike(text, pattern), moved).otherwise(empty)


def _tag(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def _addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none when nothing has been written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger) if there else spark.createDataFrame([], LEDGER_SCHEMA)


def scan_blobs(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks and append it.

    A run that dies before its write ends leaves no rows, so the next run scans the same blobs again.
    """
    spark = docs.sparkSession
    rows = _addressed(docs, id_col, text_col).select("blob", "text")
    known = read_ledger(spark, ledger)
    wanted = F.array(*[F.lit(_tag(r)) for r in rules])
    if known.isEmpty():
        blobs = rows.dropDuplicates(["blob"]).withColumn("missing", wanted)
    else:
        # Addresses tell what is missing; only the texts that are go on.
        seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
        missing = F.array_except(wanted, F.coalesce("seen", F.expr("cast(array() as array<string>)")))
        pending = cut(rows.select("blob").distinct().join(seen, "blob", "left").select("blob", missing.alias("missing")).where(F.size("missing") > 0))
        if pending.isEmpty():
            return
        blobs = rows.join(pending, "blob").dropDuplicates(["blob"])
    scanned = blobs.select(
        "blob",
        F.explode(F.array(*[
            F.when(
                F.array_contains("missing", _tag(r)),
                F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), _spans(F.col("text"), r).alias("spans")),
            )
            for r in rules
        ])).alias("row"),
    )
    scanned.where("row is not null").select("blob", "row.*").write.mode("append").parquet(ledger)


def find_secrets(
    docs: DataFrame,
    ledger: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and ``found``, an array of (start, rank, stop, kind) in that order.

    ``rank`` is the place of the rule in ``rules``. Offsets count code points, ends are exclusive.
    Null texts are empty; rows without a finding get an empty array; repeated rows, and rows whose id
    is null, are answered each. ``ledger`` is a folder that outlives the call; without one a new one is made.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "blob-ledger")
    scan_blobs(docs, ledger, id_col, text_col, rules)
    per_blob = findings(spark, ledger, rules)
    none = F.expr("cast(array() as array<struct<start:int,rank:int,stop:int,kind:string>>)")
    rows = _addressed(docs, id_col, text_col).select("id", "blob")
    return rows.join(per_blob, "blob", "left").select(F.col("id").alias(id_col), F.coalesce("found", none).alias("found"))


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``found`` of the ledger's blobs in which ``rules`` have found something."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(_tag(r)), F.lit(i))])
    hits = read_ledger(spark, ledger).where(F.size("spans") > 0)
    hits = hits.withColumn("rank", rank[F.concat_ws("@", "rule", "version")]).where("rank is not null")
    # A rule and blob that two interrupted runs scanned are listed once.
    per_rule = hits.groupBy("blob", "rule", "rank").agg(F.max("spans").alias("spans"))
    return per_rule.groupBy("blob").agg(
        F.array_sort(F.flatten(F.collect_list(F.expr(
            "transform(spans, s -> named_struct('start', s.start, 'rank', rank, 'stop', s.stop, 'kind', rule))"
        )))).alias("found")
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, hash of the base spans, and all spans as text."""
    base = len(BASE_RULES)
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    of_kind = lambda kind: F.filter("found", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    return found.select(
        id_col,
        *counts,
        F.sha2(listed(F.filter("found", lambda s: s["rank"] < base)), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]", ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; overlapping spans count as one.

    A private key goes from its first line to its last one or, where there is none before the next first line, over the runs of base64
    that follow. Columns and rows stay as they are; a null text stays null. Findings belong to a text, so rows without an
    id and rows that share one are masked each by its own; repeated rows stay repeated. The work grows with a text and its findings,
    not with their product.
    """
    key, hits = free_name(docs, "found_in"), free_name(docs, "found")
    ledger = ledger or scratch_path(docs.sparkSession, "blob-ledger")
    scan_blobs(docs, ledger, id_col, text_col, MASKED_RULES)
    found = _stretches(_merged(_spans_to_mask(docs.sparkSession, ledger))).select(F.col("blob").alias(key), F.col("hit").alias(hits))
    text = F.col(text_col)
    pieces = F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % STRETCH), 0)
    joined = docs.join(found, F.unhex(F.sha2(text, 256)) == F.col(key), "left").withColumn(key, F.when(F.col(hits).isNotNull(), pieces))
    return joined.select(*[
        F.when(F.col(hits).isNotNull(), _masked(F.col(key), F.col(hits), mask)).otherwise(text).alias(c) if c == text_col else F.col(c)
        for c in docs.columns
    ])


def _spans_to_mask(spark: SparkSession, ledger: str) -> DataFrame:
    """``blob``, ``start`` and ``stop`` of what ``MASKED_RULES`` have found, ends of keys paired with their beginnings."""
    tags = [_tag(r) for r in MASKED_RULES]
    hits = read_ledger(spark, ledger).where(F.concat_ws("@", "rule", "version").isin(tags))
    spans = hits.select("blob", "rule", F.inline("spans")).distinct()
    of_key = F.col("rule").isin(KEY_BEGIN.kind, KEY_END.kind)
    in_order = Window.partitionBy("blob").orderBy("start")
    ends_at = F.when(F.lead("rule").over(in_order) == KEY_END.kind, F.lead("stop").over(in_order))
    keys = spans.where(of_key).withColumn("stop", F.when(F.col("rule") == KEY_BEGIN.kind, F.greatest("stop", ends_at)).otherwise(F.col("stop")))
    return spans.where(~of_key).unionByName(keys.where(F.col("rule") == KEY_BEGIN.kind)).select("blob", "start", "stop")


def _merged(spans: DataFrame) -> DataFrame:
    """Spans that overlap as one."""
    in_order = Window.partitionBy("blob").orderBy("start", "stop")
    before = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("begins", F.when(F.col("start") < before, 0).otherwise(1))
    numbered = begun.withColumn("n", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("blob", "n").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def _stretches(spans: DataFrame) -> DataFrame:
    """``hit`` of every blob: the stretches of its text that spans lie in, with their places there. ``first`` is where a span begins."""
    cut_up = spans.select("blob", "start", "stop", F.explode(F.sequence(F.expr(f"start div {STRETCH}"), F.expr(f"(stop - 1) div {STRETCH}"))).alias("at"))
    begin = F.col("at") * STRETCH
    place = F.struct(
        F.greatest(F.col("start") - begin, F.lit(0)).cast("int").alias("start"),
        F.least(F.col("stop") - begin, F.lit(STRETCH)).cast("int").alias("stop"), (F.col("start") >= begin).alias("first"),
    )
    of_stretch = cut_up.groupBy("blob", F.col("at").cast("int").alias("at")).agg(F.sort_array(F.collect_list(place)).alias("places"))
    return of_stretch.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("at", "places"))).alias("hit"))


def _masked(pieces: Column, hits: Column, mask: str) -> Column:
    """A text put together again from its stretches; those with places are walked through, the others taken as they are."""

    def without(piece: Column, places: Column) -> Column:
        walked = F.aggregate(
            places,
            F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
            lambda acc, s: F.struct(
                s["stop"].alias("at"),
                F.concat(acc["out"], F.substring(piece, acc["at"] + 1, s["start"] - acc["at"]), F.when(s["first"], mask).otherwise("")).alias("out"),
            ),
        )
        return F.concat(walked["out"], F.substring(piece, walked["at"] + 1, F.lit(STRETCH)))

    def upto(hit: Column, i: Column) -> Column:
        last = F.when(i > 0, F.get(hits, i - 1)["at"]).otherwise(-1)
        untouched = F.array_join(F.slice(pieces, last + 2, hit["at"] - last - 1), "")
        return F.concat(untouched, without(F.get(pieces, hit["at"]), hit["places"]))

    last = F.element_at(hits, -1)["at"]
    rest = F.array_join(F.slice(pieces, last + 2, F.greatest(F.size(pieces) - last - 1, F.lit(0))), "")
    return F.concat(F.array_join(F.transform(hits, upto), ""), rest)

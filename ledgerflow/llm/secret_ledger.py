"""Secret scans: an incremental ledger of scanned blobs.

Every version of every text is addressed by its content (SHA-256).  A text that
occurs under many paths or in many versions is one blob; a blob is scanned once
per rule version, and the ledger (a Parquet table in a shared folder) remembers
what was scanned and what was found, so the next call scans only the pairs of
blob and rule version that it has not seen.  Findings are then joined back to
all paths.  Only DataFrame functions run.

Nulls and edges: a null text counts as empty; an empty text has no spans; a
null in any other column is carried through.  Repeated rows each get their
findings.  An empty table gives an empty result.  Input columns are carried
under their own names; the operator's own columns live in structs until the
end, and a clash with a result name raises a clear error.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a Java pattern, and the least length of one of its groups."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the scan, in the order in which ties are listed.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),  # a run of 32 or more is a maximal run that is long enough
)

SPANS = "array<struct<start:bigint,end:bigint>>"


def _matched(text: Column, rule: Rule) -> Column:
    """For each match: characters before it since the last one, its length, and whether it is long enough."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    return F.when(
        text.rlike(rule.pattern),
        F.transform(
            F.arrays_zip(F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"), whole.alias("whole"), part.alias("part")),
            lambda m: F.struct(
                F.length(m["gap"]).cast("long").alias("gap"),
                F.length(m["whole"]).cast("long").alias("size"),
                (F.length(m["part"]) >= rule.least).alias("kept"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<gap:bigint,size:bigint,kept:boolean>>"))


def _address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger so far, or None before its first batch."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return None
    return spark.read.schema(f"blob string, rule string, spans {SPANS}").parquet(path)


def scan_blobs(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Scan the blobs of ``versions`` that ``ledger`` lacks, append them, and return the ledger.

    One row per (blob, rule): blob, rule (kind@version), spans (code points,
    end exclusive, in order).  A blob's text is shuffled once; the copies of a
    hot blob meet in the map-side aggregation.
    """
    spark = versions.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    found = versions.select(F.sha2(body, 256).alias("blob"), body.alias("body"))
    known = _ledger(spark, ledger)
    if known is not None:
        complete = (
            known.where(F.col("rule").isin([r.key for r in rules])).groupBy("blob")
            .agg(F.collect_set("rule").alias("seen"))
        )
        found = found.join(complete, "blob", "left")
        found = found.where(F.coalesce(F.size("seen"), F.lit(0)) < len({r.key for r in rules}))
        # `seen` depends on the blob alone, so any copy's value will do.
        blobs = found.groupBy("blob").agg(F.first("body").alias("body"), F.first("seen").alias("seen"))
    else:
        blobs = found.groupBy("blob").agg(F.first("body").alias("body")).withColumn("seen", F.lit(None).cast("array<string>"))
    # Only pairs not seen before are matched: the others are null and dropped below.
    unseen = lambda r: ~F.coalesce(F.array_contains("seen", r.key), F.lit(False))
    pairs = blobs.select("blob", F.explode(F.array(*(
        F.struct(F.lit(r.key).alias("rule"), F.when(unseen(r), _matched(F.col("body"), r)).alias("hits")) for r in rules
    ))).alias("pair")).select("blob", "pair.rule", "pair.hits").where(F.col("hits").isNotNull())
    # A running sum along a pair's hits turns gaps and lengths into positions.  A pair without hits keeps one row.
    hits = pairs.select("blob", "rule", F.posexplode_outer("hits").alias("pos", "hit"))
    along = Window.partitionBy("blob", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = hits.withColumn("end", F.sum(F.col("hit.gap") + F.col("hit.size")).over(along))
    span = F.when(F.col("hit.kept"), F.struct((F.col("end") - F.col("hit.size")).alias("start"), "end"))
    spans = placed.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    # A batch becomes visible under the ledger only when its write has been committed.
    spans.write.mode("append").parquet(ledger)
    return _ledger(spark, ledger)


def scan(versions: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """All rows of ``versions`` with ``secrets``: array of struct(start, kind_no, kind, end) in order of start.

    ``ledger`` is the folder of the ledger; without one a fresh ledger in the
    shared checkpoint folder serves this call alone.
    """
    if "secrets" in versions.columns or "__blob" in versions.columns:
        raise ValueError("input must not have columns named secrets or __blob")
    spark = versions.sparkSession
    path = ledger or scratch_path(spark, f"secret-ledger-{uuid4().hex}")
    known = scan_blobs(versions, path, rules, text)
    order = {r.key: i for i, r in enumerate(rules)}
    kind_no = F.create_map(*(F.lit(x) for kv in order.items() for x in kv))
    kind = F.create_map(*(F.lit(x) for r in rules for x in (r.key, r.kind)))
    # Blobs without findings need no row: the left join below gives them none.
    found = (
        known.where(F.col("rule").isin(list(order)) & (F.size("spans") > 0))
        .select("blob", F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), kind_no[F.col("rule")].alias("kind_no"),
            kind[F.col("rule")].alias("kind"), s["end"].alias("end"))).alias("part"))
        # A set: two callers at a time may both have noted a pair.
        .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_set("part"))).alias("secrets"))
        .withColumnRenamed("blob", "__blob")
    )
    out = versions.withColumn("__blob", _address(F.col(text))).join(found, "__blob", "left").drop("__blob")
    empty = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>")
    return out.withColumn("secrets", F.coalesce("secrets", empty))


def digest(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


#: Characters of a block: cutting a piece out of a text reads the blocks that it touches, not the text from its start.
_BLOCK = 1024


def redact(scanned: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Replace every span of ``secrets`` in ``text`` by ``mark`` (overlapping spans by one mark).

    Equal texts have equal spans, so each distinct text with spans is redacted
    once and joined back.  The work is about linear in the text and its spans.
    """
    if "__blob" in scanned.columns or "__clean" in scanned.columns:
        raise ValueError("input must not have columns named __blob or __clean")
    # Rows without spans meet no text; a key of their own spreads them over the tasks.
    spread = F.concat(F.lit("-"), F.xxhash64(*[F.col(c) for c in scanned.columns if c != "secrets"]).cast("string"))
    rows = scanned.withColumn("__blob", F.when(F.size("secrets") > 0, _address(F.col(text))).otherwise(spread))
    blobs = rows.where(F.size("secrets") > 0).groupBy("__blob").agg(F.first(text).alias("body"), F.first("secrets").alias("secrets"))
    # The text between the marks: from the furthest end so far to a start beyond it.
    spans = blobs.select("__blob", F.posexplode("secrets").alias("pos", "s")).select("__blob", "pos", "s.start", "s.end")
    earlier = Window.partitionBy("__blob").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    opens = F.when(F.col("start") >= F.col("before"), F.struct(F.col("before").alias("a"), F.col("start").alias("b")))
    bounds = spans.groupBy("__blob").agg(F.array_sort(F.collect_list(opens)).alias("bounds"), F.max("end").alias("last"))
    blocks = F.regexp_extract_all("body", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    cut = blobs.select("__blob", blocks.alias("blocks")).join(bounds, "__blob")

    def piece(lo: Column, hi: Column) -> Column:
        first = F.floor(lo / _BLOCK).cast("int")
        touched = F.slice("blocks", first + 1, F.greatest(F.ceil(hi / _BLOCK).cast("int") - first, F.lit(0)))
        return F.substring(F.array_join(touched, ""), (lo - first * _BLOCK + 1).cast("int"), (hi - lo).cast("int"))

    length = (F.size("blocks") - 1) * _BLOCK + F.length(F.element_at("blocks", -1))
    pieces = F.transform("bounds", lambda x: F.concat(piece(x["a"], x["b"]), F.lit(mark)))
    clean = cut.select("__blob", F.concat(F.array_join(pieces, ""), piece(F.col("last"), length)).alias("__clean"))
    joined = rows.join(clean, "__blob", "left").withColumn(text, F.coalesce("__clean", text))
    return joined.select(*[c for c in scanned.columns if c != "secrets"])

"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a document is a blob, addressed by the SHA-256 of its text. The ledger has a
row for each (blob, rule, rule version) scanned, with the spans found, none included. A scan
takes the distinct blobs of its input, leaves out pairs of blob and rule version that the
ledger has, scans the rest once however many paths hold the blob, appends to the ledger, and
joins findings back to all paths.

Spark's regular expressions give no positions. The pieces between matches (``split``) and the
matches (``regexp_extract_all``) do: a match starts where the pieces and matches before it end.
Positions count code points; ends are exclusive.

Sums run over pieces in chunks of ``CHUNK``, so that no array grows by one a match, and texts are
put together again from runs of characters: time follows the text, however many matches it has.

Defined cases: a null text counts as empty and has no findings; very long texts are scanned
whole; rows that repeat keep a row each; equal texts share a blob; an empty table gives no rows;
further columns are ignored by :func:`scan` and kept by :func:`redact`, whatever their names
(but for those beginning with two underscores). Ids of any type will do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quantloom.llm._common import scratch_path


@dataclass(frozen=True)
class Rule:
    """``least`` code points are needed in ``group``; matches that fail are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base kinds, in the order that breaks ties.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

ENDS = "array<struct<start:int,end:int>>"
LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"
_STEPS = "array<struct<gap:int,size:int,judged:int>>"
#: Matches that one running sum goes over.
CHUNK = 128
#: A session's setting that names a ledger to keep; without it a scan has a ledger of its own.
LEDGER_SETTING = "spark.quantloom.secret.ledger"


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _steps(text: Column, rule: Rule) -> Column:
    """For each match the length of the piece before it, of itself and of what is judged; few texts have any."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    sized = F.zip_with(F.split(text, rule.pattern, -1), F.arrays_zip(whole.alias("whole"), judged.alias("judged")), lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["whole"]).alias("size"), F.length(m["judged"]).alias("judged")))
    return F.when(text.rlike(rule.pattern), F.filter(sized, lambda s: s["size"].isNotNull())).otherwise(_none(_STEPS))


def _chunks(steps: Column) -> Column:
    return F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")), lambda k: F.slice(steps, k * CHUNK + 1, CHUNK))).otherwise(_none(f"array<{_STEPS}>"))


def _bases(chunks: Column) -> Column:
    """Where each chunk begins, and at last where the last one ends."""
    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda at, s: at + s["gap"] + s["size"]))
    return F.aggregate(sums, F.array(F.lit(0)), lambda ends, n: F.concat(ends, F.array(F.element_at(ends, -1) + n)))


def _spans(chunks: Column, bases: Column, least: int) -> Column:
    """array<struct<start, end>> of the matches that are long enough."""
    placed = lambda c, base: F.aggregate(
        c,
        F.struct(base.alias("at"), _none(ENDS).alias("found")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["size"]).alias("at"),
            F.when(s["judged"] >= least, F.concat(acc["found"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["size"]).alias("end"))))).otherwise(acc["found"]).alias("found"),
        ),
        lambda acc: acc["found"],
    )
    return F.flatten(F.zip_with(chunks, F.slice(bases, F.lit(1), F.size(chunks)), placed))


def ledger(spark: SparkSession) -> BlobLedger:
    """The ledger that LEDGER_SETTING names, else a new one."""
    return BlobLedger(spark, spark.conf.get(LEDGER_SETTING, None))


class BlobLedger:
    """What has been scanned, as a Parquet table that only grows."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "secret-ledger")

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.range(0).select(F.lit("").alias("blob"), F.lit("").alias("rule"), F.lit(0).alias("version"), _none(ENDS).alias("spans"))

    def update(self, blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan the pairs of (blob, text) and rule that are not in the ledger; return the ledger."""
        known = self.read()
        if not known.isEmpty():
            seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("__seen"))
            blobs = blobs.join(seen, "blob", "left")
            open_to = {r: ~F.coalesce(F.array_contains("__seen", r.key), F.lit(False)) for r in rules}
        else:
            open_to = {r: F.lit(True) for r in rules}
        names = [str(k) for k in range(len(rules))]
        # Each step is a column of its own, so that it is computed once.
        fresh = blobs.withColumns({f"__s{k}": F.when(open_to[r], _steps(F.col("text"), r)) for k, r in zip(names, rules, strict=True)})
        fresh = fresh.withColumns({f"__c{k}": _chunks(F.col(f"__s{k}")) for k in names}).withColumns({f"__b{k}": _bases(F.col(f"__c{k}")) for k in names})
        scanned = F.array(*(F.when(F.col(f"__s{k}").isNotNull(), F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), _spans(F.col(f"__c{k}"), F.col(f"__b{k}"), r.least).alias("spans"))) for k, r in zip(names, rules, strict=True)))
        fresh = fresh.select("blob", F.inline(F.array_compact(scanned)))
        fresh.write.mode("append").parquet(self.path)
        return self.read()


def _paths(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def findings(docs: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) for the blobs of ``docs`` that have findings; found: array<struct<start, kind_at, end, kind>> by start, then kind."""
    rows = _paths(docs, id_col, text_col)
    blobs = rows.select("blob", "text").dropDuplicates(["blob"])
    known = ledger.update(blobs, rules)
    wanted = F.array(*(F.lit(r.key) for r in rules))
    order = F.array(*(F.lit(r.kind) for r in rules))
    hits = known.where(F.array_contains(wanted, F.concat_ws("@", "rule", "version")) & (F.size("spans") > 0)).join(rows.select("blob").distinct(), "blob", "left_semi").dropDuplicates(["blob", "rule", "version"])
    each = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(order, F.col("rule")).alias("kind_at"), s["end"].alias("end"), F.col("rule").alias("kind")))
    return hits.select("blob", each.alias("found")).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))


def scan(docs: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, blob, found."""
    found = findings(docs, ledger, id_col, text_col, rules)
    paths = _paths(docs, id_col, text_col).select("doc_id", "blob")
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("found", _none("array<struct<start:int,kind_at:bigint,end:int,kind:string>>")).alias("found"))


def _runs(found: DataFrame) -> DataFrame:
    """(blob, found) -> (blob, runs): runs of overlapping spans with the end of the run before, in order."""
    each = found.select("blob", F.posexplode("found").alias("k", "s")).select("blob", "k", "s.start", "s.end")
    order = Window.partitionBy("blob").orderBy("k")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = each.withColumn("__before", F.coalesce(before, F.lit(0))).withColumn("run", F.count_if((F.col("__before") <= F.col("start"))).over(order))
    run = new.groupBy("blob", "run").agg(F.min("__before").alias("since"), F.min("start").alias("start"), F.max("end").alias("end"))
    return run.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("since", "start", "end"))).alias("runs"))


def redact(docs: DataFrame, ledger: BlobLedger, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``mark``; clean texts stay as they are, null too."""
    runs = _runs(findings(docs, ledger, id_col, text_col, rules)).withColumnsRenamed({"blob": "__blob", "runs": "__runs"})
    keyed = docs.withColumn("__key", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).join(runs, F.col("__key") == F.col("__blob"), "left")
    # The characters are a column of their own, read twice below: they are split once.
    keyed = keyed.withColumn("__chars", F.when(F.col("__runs").isNotNull(), F.split(F.col(text_col), "")))
    part = lambda start, end: F.array_join(F.slice("__chars", start + 1, end - start), "")
    cleared = F.array_join(F.transform("__runs", lambda r: F.concat(part(r["since"], r["start"]), F.lit(mark))), "")
    tail = part(F.element_at("__runs", -1)["end"], F.size("__chars"))
    return keyed.withColumn(text_col, F.when(F.col("__runs").isNull(), F.col(text_col)).otherwise(F.concat(cleared, tail))).select(*docs.columns)

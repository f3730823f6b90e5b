"""Secret scans with a ledger of what has been scanned.

Texts are content-addressed: a blob is the SHA-256 of a text. The ledger, a
folder of Parquet files, has a row for every blob and rule version that was
scanned, with the spans found. A scan of any set of paths, whatever versions of
their texts it holds, applies a rule version only to blobs that the ledger does
not have it for, one row per blob, appends what it did, and joins the ledger
back to all paths.

Spans come from SQL functions alone: a pattern's matches and the texts between
them, which the same engine cuts at the same places, have lengths that add up to
positions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlift.llm.sketch import mark_possible
from offerlift.llm.texts import text_or_empty
from offerlift.sources.workspace import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0

    @property
    def mark(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds. For the last two, a longer minimum inside the
# pattern is the same as dropping short matches: both have one run of one class.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)

SPANS = "array<struct<start:bigint,end:bigint>>"
LEDGER = f"blob binary, mark string, spans {SPANS}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans(rule: Rule, text: str) -> str:
    """SQL for the spans of ``rule`` in column ``text``: code points, end exclusive."""
    pattern = _quoted(rule.pattern)
    lengths = (
        f"arrays_zip(transform(split({text}, {pattern}, -1), p -> length(p)),"
        f" transform(regexp_extract_all({text}, {pattern}, 0), m -> length(m)),"
        f" transform(regexp_extract_all({text}, {pattern}, {rule.group}), g -> length(g)))"
    )
    found = (
        f"aggregate({lengths}, named_struct('at', 0L, 'out', cast(array() as {SPANS})),"
        " (a, x) -> named_struct('at', a.at + x['0'] + coalesce(x['1'], 0),"
        f" 'out', if(x['2'] >= {rule.least}, array_append(a.out, named_struct("
        "'start', a.at + x['0'], 'end', a.at + x['0'] + x['1'])), a.out)), a -> a.out)"
    )
    return f"if({text} rlike {pattern}, {found}, cast(array() as {SPANS}))"


def read_ledger(docs: DataFrame, ledger: str) -> DataFrame:
    """The ledger's rows; none where it has not been written yet."""
    spark = docs.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(ledger) if exists else spark.createDataFrame([], LEDGER)


def scan(
    docs: DataFrame,
    ledger: str,
    rules: Sequence[Rule] = BASE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, findings`` of every row of ``docs``; findings are structs of kind, start and end.

    Findings are in order of start, then of the rules. Rows are paths or
    versions of them: rows with equal texts share one scan, repeated rows and
    null keys keep their rows. A null text is empty. Other columns are ignored;
    an empty table gives an empty one and leaves the ledger as it is.
    """
    texts = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    texts = texts.select("key", F.unhex(F.sha2("text", 256)).alias("blob"), "text")
    heads = materialize(texts.select("key", "blob"), "blobs")
    marks = F.array(*[F.lit(r.mark) for r in rules])
    blobs = heads.groupBy("blob").agg(F.min("key").alias("first"))
    pairs = blobs.select("blob", "first", F.explode(marks).alias("mark"))
    known = read_ledger(docs, ledger)
    unseen = pairs.join(known, ["blob", "mark"], "left_anti").groupBy("blob", "first")
    unseen = materialize(unseen.agg(F.collect_set("mark").alias("marks")), "unseen")

    new = mark_possible(texts, "blob", unseen, "possible").where("possible").drop("possible")
    new = new.join(unseen, "blob").where(F.col("key").eqNullSafe(F.col("first")))
    results = F.array(
        *[
            F.when(
                F.array_contains("marks", r.mark),
                F.struct(F.lit(r.mark).alias("mark"), F.expr(spans(r, "text")).alias("spans")),
            )
            for r in rules
        ]
    )
    results = F.inline(F.filter(results, lambda x: x.isNotNull()))
    scanned = new.select("blob", results).dropDuplicates(["blob", "mark"])
    scanned.write.mode("append").parquet(ledger)

    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.mark, i)])
    rows = read_ledger(docs, ledger).where(F.size("spans") > 0)
    rows = rows.where(F.col("mark").isin([r.mark for r in rules]))
    rows = rows.select("blob", ranks[F.col("mark")].alias("rank"), "mark", F.inline("spans"))
    one = F.struct("start", "rank", "end", F.split_part("mark", F.lit("@"), F.lit(1)).alias("kind"))
    rows = rows.groupBy("blob").agg(F.array_sort(F.collect_list(one)).alias("all"))
    rows = materialize(
        rows.select("blob", F.expr("transform(all, f -> struct(f.kind, f.start, f.end))").alias("f")),
        "findings",
    )
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint>>)")
    return heads.join(rows, "blob", "left").select(
        F.col("key").alias(key), F.coalesce("f", none).alias("findings")
    )

"""Secret scans over an incremental blob ledger (built-in functions only).

Every version of every document is addressed by the sha256 of its text. The ledger holds one row
per scanned (blob, rule version) pair with the spans found. An increment scans only the pairs the
ledger lacks, each blob once however many documents hold it, appends them, and joins the findings
back to all paths (documents). A rerun after a lost job scans only what is still missing.

Spans are code points, end exclusive. Matches of one rule are leftmost and don't overlap.

Defined results: a null text is the empty blob; texts are scanned whole; repeated rows and copies
share one scan and each gets the findings; an empty table gives an empty result. Other columns are
left alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventsieve.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0


#: A private key: its header line, and what ``key_length`` finds after it. All patterns are single
#: characters or runs of one class, so the matcher needs no stack, and both regex dialects read them alike.
HEADER, END = r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----END [A-Z ]*PRIVATE KEY-----"
BREAK, LINE, SIGNS = r"\\[rn]", r"[A-Za-z0-9+/=]+", r"""\x20\t\r\n>#*|;%"',\\:-"""
ENCRYPTION = rf"^[{SIGNS}]*(Proc-Type|DEK-Info):[^\r\n]*"
LINE_STOP = r"""^["',;\x20\t\\]*[\r\n]"""
#: Base64 characters that a line of a key has at least (the last may have fewer), and without a line break before it.
LINE_CHARS, INLINE_CHARS = 16, 32

#: The first three kinds in this order, then the added ones.
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 30),
    Rule("pem", HEADER, 20),
)
RULE_VERSION = 4  # 1 took a key's header alone, 3 up to 400 lines; 2 is the tests' other version

SPAN = "struct<start:int,ord:int,end:int,kind:string>"
LEDGER = T.StructType([
    T.StructField("blob", T.BinaryType()),
    T.StructField("rule_version", T.IntegerType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("ord", T.IntegerType()),
        T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))),
])


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _may_match(rule: Rule) -> str:
    """A pattern that every counted match of the rule contains, cheaper to look for."""
    return r"[0-9a-f]{%d}" % rule.least if rule.kind == "hex" else rule.pattern


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule: what lies between the matches (split) and the matches give the places."""
    pattern = r"[0-9a-f]{%d,}" % rule.least if rule.kind == "hex" else rule.pattern  # same runs, without the short ones
    parts = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)).alias("g"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        found = F.when(F.length(x["g"]) >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), found.alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(_may_match(rule)), F.aggregate(parts, start, step, lambda a: a["spans"])).otherwise(none)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cut(text: Column, pattern: str) -> Column:
    """The matches of a pattern with the text before each of them (``g``, ``t``) and after it (``n``)."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(F.struct(gaps.alias("gaps"), found.alias("found")), lambda x: F.arrays_zip(
        F.slice(x["gaps"], F.lit(1), F.size(x["found"])).alias("g"), x["found"].alias("t"), F.slice(x["gaps"], F.lit(2), F.size(x["found"])).alias("n")))


def key_length(after: Column) -> Column:
    """Characters of a private key after its header line, in the text up to the next header.

    With an END line the key goes up to it, if what lies between holds ASCII only and not more words
    (runs of base64 characters with a letter, shorter than a line; the last one aside) than lines;
    otherwise it is prose about keys. Without one, or in prose, it takes the lines that follow at once:
    each after a line break, with nothing but quote and comment signs between them, and at their end
    a shorter line that stands alone. An encryption header may come first. A line break may be
    written as \\n."""
    text = F.regexp_replace(after, BREAK, "\n\n")  # keeps the places

    def short(t: Column) -> Column:
        return t.rlike("[A-Za-z]") & (F.length(t) < LINE_CHARS)

    def closed(rest: Column) -> Column:
        inner = F.element_at(F.split(rest, END, 2), 1)
        return _let(F.struct(inner.alias("inner"), F.regexp_extract_all(inner, F.lit(LINE), F.lit(0)).alias("runs")), lambda x: F.when(
            rest.rlike(END) & ~x["inner"].rlike(r"[^\x00-\x7F]")
            & (F.size(F.filter(F.slice(x["runs"], F.lit(1), F.greatest(F.size(x["runs"]) - 1, F.lit(0))), short))
               <= F.size(F.filter(x["runs"], lambda t: F.length(t) >= LINE_CHARS))),
            F.length(x["inner"]) + F.length(F.regexp_extract(rest, END, 0))))

    def kind(x: Column) -> Column:
        """2: a line of the key, 1: signs alone, 3: a last line, 0: anything else."""
        clean, broken = ~x["g"].rlike(f"[^{SIGNS}]"), x["g"].rlike(r"[\r\n]")
        size = F.length(x["t"])
        return (
            F.when(clean & (size >= LINE_CHARS) & (broken | (size >= INLINE_CHARS)), "2")
            .when(clean & ~x["t"].rlike("[A-Za-z]") & (size < LINE_CHARS), "1")
            .when(clean & broken & short(x["t"]) & x["n"].rlike(LINE_STOP), "3").otherwise("0"))

    def lines(rest: Column) -> Column:
        def upto(x: Column) -> Column:
            run, held = F.regexp_extract(x["kinds"], "^[12]*", 0), F.regexp_extract(x["kinds"], "^[12]*2", 0)
            last = (F.length(held) > 0) & (F.substring(x["kinds"], F.length(run) + 1, F.lit(1)) == "3")
            count = F.when(last, F.length(run) + 1).otherwise(F.length(held))
            return F.aggregate(F.slice(x["runs"], F.lit(1), count), F.lit(0), lambda a, y: a + F.length(y["g"]) + F.length(y["t"]))

        return _let(_cut(F.concat(rest, F.lit("\n")), LINE), lambda runs:  # the text's end ends a line
            _let(F.struct(runs.alias("runs"), F.array_join(F.transform(runs, kind), "").alias("kinds")), upto))

    def from_text(t: Column) -> Column:
        first = F.length(F.regexp_extract(t, ENCRYPTION, 0))
        skip = first + F.length(F.regexp_extract(F.substring(t, first + 1, F.length(t)), ENCRYPTION, 0))
        return _let(skip, lambda k: _let(F.substring(t, k + 1, F.length(t)), lambda rest: _let(
            F.coalesce(closed(rest), lines(rest)), lambda n: F.when(n > 0, k + n).otherwise(0))))

    return _let(text, from_text)


def key_spans(text: Column, order: int) -> Column:
    """Spans of private keys; a key ends before the next header."""
    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["t"])
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), (end + key_length(x["n"])).alias("end"), F.lit("pem").alias("kind"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(HEADER), F.aggregate(_cut(text, HEADER), start, step, lambda a: a["spans"])).otherwise(none)


def scan(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text, by start, then by the order of the rules."""
    return F.array_sort(F.concat(*[(key_spans(text, i) if r.kind == "pem" else rule_spans(text, r, i)) for i, r in enumerate(rules)]))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger's rows; none if no increment has been written yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LEDGER).parquet(folder) if there else spark.createDataFrame([], LEDGER)


def scan_increment(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, rule_version: int = RULE_VERSION) -> DataFrame:
    """Scan the blobs of ``versions(doc_id, text)`` that ``ledger`` has not seen under this rule
    version, append them to it, and return the ledger's findings of this rule version."""
    spark = versions.sparkSession
    rows = versions.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = rows.select("doc_id", blob(F.col("text")).alias("blob")).groupBy("blob").agg(F.min("doc_id").alias("_holder"))
    seen = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version).select("blob")
    unseen = held.join(seen, "blob", "left_anti").hint("shuffle_hash")
    # one holder per blob; blob and holder together spread the copies of a common text
    texts = rows.withColumn("_b", blob(F.col("text"))).join(
        unseen, (F.col("_b") == F.col("blob")) & F.col("doc_id").eqNullSafe(F.col("_holder")), "inner"
    )
    found = texts.select("blob", F.lit(rule_version).alias("rule_version"), scan(F.col("text"), rules).alias("spans"))
    found = found.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))  # rows repeated with their id
    found.write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version)


def _joined(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def findings_by_document(docs: DataFrame, ledger: str) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    found = scan_increment(docs, ledger).filter(F.size("spans") > 0).select("blob", "spans")
    paths = docs.select("doc_id", blob(F.col("text")).alias("blob"))
    out = paths.join(found, "blob", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))
    kinds = F.transform("spans", lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("spans", lambda s: s["ord"] < len(BASE))
    return out.select("doc_id", *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[kind]``; overlapping spans become one."""
    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        mark = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], kept, mark).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def mask_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """The rows of ``docs`` (all columns) with secrets masked in ``text``."""
    ledger = ledger or scratch_path(docs.sparkSession, "secret-ledger")
    found = scan_increment(docs, ledger).filter(F.size("spans") > 0).select(F.col("blob").alias("_b"), F.col("spans").alias("_found"))
    rows = docs.withColumn("_blob", blob(F.col("text"))).join(found, F.col("_blob") == F.col("_b"), "left")
    text = F.when(F.col("_found").isNull(), F.col("text")).otherwise(mask(F.col("text"), F.col("_found")))
    return rows.withColumn("text", text).select(*docs.columns)

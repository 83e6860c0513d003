"""Converting sections to markup: prompts, rules, the conversion log.

Calls to a model never stand in a lazy plan: a job takes the sections that the
log doesn't hold as done, converts them and appends to the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import retryable, split_lines, strip
from ..sources.transport import Pace, Transport, call_with_retry, cool_down

LOG_SCHEMA = "doc_id long, ord int, num string, content_hash string, prompt_ver string, model string, status string, markup string, error string, attempts int"
PROMPT_VERSION = "2"
#: The rules of the markup; keywords and the placeholder's form are fixed values.
RULES = (
    "A section starts with: SEC [num]. - [heading]",
    "What belongs to a section stands two blanks deeper than its SEC line",
    "SUBSEC (1), SUBSEC (2), ... open subsections, on lines of their own under SEC; the text follows one level deeper",
    "PARA (a), PARA (b), ... open paragraphs of a subsection in the same way",
    "SUBPARA (i), SUBPARA (ii), ... open subparagraphs of a paragraph in the same way",
    'An explanation is an indented paragraph that begins with "Explanation.—"',
    'An illustration is an indented paragraph that begins with "Illustration", or with its letter',
    'An exception is an indented paragraph that begins with "Exception"',
    'A proviso is an indented paragraph that begins with "Provided that"',
    "A line <<TABLE_REGION:N>> stands for a table that is put in later: keep it as it is, on a line of its own and at its depth; never describe, wrap, drop or render it",
)
PROMPT = "Convert this section of {document} to indented legal markup.\n" + "\n".join(f"{n}. {rule}" for n, rule in enumerate(RULES, 1)) + "\nKeep the words of the law as they are. Give the markup alone.\nSection number: {num}\nHeading: {heading}\nContent:\n{content}"


def prompts(sections: DataFrame, document: str = "Legislative Document", template: str = PROMPT) -> DataFrame:
    out: Column = F.lit(template.replace("{document}", document))
    for name in ("num", "heading", "content"):
        out = F.replace(out, F.lit(f"{{{name}}}"), F.col(name))
    return sections.withColumn("prompt", out)


def rule_markup(num: Column, heading: Column, content: Column) -> Column:
    """Markup by rules, without a model: (1) opens SUBSEC, (a) PARA, (i) SUBPARA; sentinels and other lines keep their place.

    One line of the content gives one line of markup.  (i), (v) and (x) count as
    roman numerals unless the line before is (h), (u) or (w)."""
    lines = F.filter(F.transform(split_lines(content), strip), lambda x: x != "")
    before = F.concat(F.array(F.lit("")), lines)
    label = lambda x: F.regexp_extract(x, r"^\(([0-9A-Za-z]+)\)", 1)

    def one(x: Column, i: Column) -> Column:
        mark, prior = label(x), label(F.get(before, i))
        follows = ((mark == "i") & (prior == "h")) | ((mark == "v") & (prior == "u")) | ((mark == "x") & (prior == "w"))
        return (
            F.when(mark.rlike("^[0-9]+$"), F.concat(F.lit("  SUBSEC "), x))
            .when(mark.rlike("^[ivxlc]+$") & ~follows & ~(mark.rlike("^[clv]$") & (prior != "iv")), F.concat(F.lit("      SUBPARA "), x))
            .when(mark.rlike("^[a-z]{1,2}$"), F.concat(F.lit("    PARA "), x))
            .otherwise(F.concat(F.lit("  "), x))
        )

    head = F.concat(F.lit("SEC "), num, F.lit(". - "), heading)
    return F.array_join(F.concat(F.array(head), F.transform(lines, one)), "\n")


def with_hash(sections: DataFrame) -> DataFrame:
    return sections.withColumn("content_hash", F.sha2(F.concat_ws("\x1f", "num", "heading", "content"), 256))


def pending(sections: DataFrame, log: DataFrame, model: str, prompt_ver: str = PROMPT_VERSION) -> DataFrame:
    """Sections (with content_hash) without an ok row in the log for this content, prompt and model.

    Failed sections are pending again, which the log's status makes possible."""
    done = log.where((F.col("status") == "ok") & (F.col("model") == model) & (F.col("prompt_ver") == prompt_ver))
    return sections.join(done.select("doc_id", "num", "content_hash").distinct(), ["doc_id", "num", "content_hash"], "left_anti")


def convert_pending(todo: DataFrame, transport: Transport, model: str, prompt_ver: str = PROMPT_VERSION, lanes: int = 4) -> DataFrame:
    """Log rows for ``todo`` (doc_id, ord, num, content_hash, prompt); ``lanes`` bounds the calls at a time.

    Every outcome has a row: ok, error, or exhausted (a passing fault that lasted)."""

    def run(frames):
        called, pace = 0, getattr(transport, "pace", None) or Pace(batch_delay=0)
        for pdf in frames:
            rows = []
            for r in pdf.itertuples(index=False):
                status, text, error, attempts = call_with_retry(transport, r.prompt)
                cool_down(called, pace)
                called += 1
                rows.append((r.doc_id, r.ord, r.num, r.content_hash, prompt_ver, model, status, text, error, attempts))
            import pandas as pd

            yield pd.DataFrame(rows, columns=[c.split()[0] for c in LOG_SCHEMA.split(", ")])

    return todo.select("doc_id", "ord", "num", "content_hash", "prompt").repartition(lanes).mapInPandas(run, LOG_SCHEMA)


def latest(log: DataFrame) -> DataFrame:
    """One ok row for each section: repeated calls of retried tasks count once."""
    order = Window.partitionBy("doc_id", "num", "content_hash", "prompt_ver", "model").orderBy("attempts", "markup")
    return log.where("status = 'ok'").withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log at ``path``, empty if there is none yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def run_conversion(sections: DataFrame, transport: Transport, model: str, path: str, document: str = "Legislative Document", lanes: int = 4) -> DataFrame:
    """Convert what the log at ``path`` doesn't hold, append it, and return the sections' latest ok rows."""
    spark = sections.sparkSession
    todo = prompts(pending(with_hash(sections), read_log(spark, path), model), document)
    convert_pending(todo, transport, model, lanes=lanes).write.mode("append").parquet(path)
    return latest(read_log(spark, path))


def fault_kinds(errors: DataFrame) -> DataFrame:
    return errors.withColumn("retryable", retryable("error"))

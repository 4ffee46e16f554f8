"""States of files and of their schemas: allowed steps, effective states, what a phase may do, and when a file is done."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: states in order, the steps from each (to "failed" from every one), and those from which reading is finished
STATES = ("ingested", "rasterized", "ocr_a", "ocr_b", "reconciled", "enumerated", "extracted", "validated", "done")
STEPS = {
    "ingested": ("rasterized",),
    "rasterized": ("ocr_a",),
    "ocr_a": ("ocr_b", "reconciled"),
    "ocr_b": ("reconciled",),
    "reconciled": ("enumerated", "extracted"),
    "enumerated": ("extracted",),
    "extracted": ("validated",),
    "validated": ("done", "needs_review"),
    "done": (),
    "needs_review": ("done",),
}
READ = ("reconciled", "enumerated", "extracted", "validated", "done", "needs_review")


def allowed(src: Column, dst: Column) -> Column:
    """Whether a state may follow another."""
    steps = [(src == a) & dst.isin(*to, "failed") for a, to in STEPS.items()]
    return F.coalesce(reduce(lambda x, y: x | y, steps), F.lit(False))


def illegal_transitions(asked: DataFrame, current: DataFrame, key: list[str]) -> DataFrame:
    """The asked steps (key, src, dst) that must not be made, with ``reason``: ``not allowed``, or ``stale`` where the current status
    (key, status) is another or unknown. Null states are not allowed."""
    now = current.select(*key, F.col("status").alias("__now"))
    rows = asked.join(now, key, "left")
    reason = F.when(~allowed(F.col("src"), F.col("dst")), "not allowed").when(~F.col("__now").eqNullSafe(F.col("src")), "stale")
    return rows.withColumn("reason", reason).where("reason is not null").drop("__now")


def effective_status(files: DataFrame, schemas: list[str], known: DataFrame) -> DataFrame:
    """doc_id, schema_name, status for each file (doc_id, status) and schema: the known one (doc_id, schema_name, status), else
    ``reconciled`` once reading is finished, else the file's."""
    wide = files.select("doc_id", F.col("status").alias("__file"), F.explode(F.array(*map(F.lit, schemas))).alias("schema_name"))
    rows = wide.join(known.select("doc_id", "schema_name", "status"), ["doc_id", "schema_name"], "left")
    return rows.select("doc_id", "schema_name", F.coalesce("status", F.when(F.col("__file").isin(*READ), "reconciled").otherwise(F.col("__file"))).alias("status"))


def skip_decision(status: Column, required: str, following: str) -> Column:
    """``skip``, ``run`` or ``error`` for a phase that leads from ``required`` to ``following``: files under review and those at or
    past ``following`` are skipped, those at ``required`` run, all others (unknown ones too) are errors."""
    place = F.array_position(F.array(*map(F.lit, STATES)), status)
    past = place > STATES.index(following)  # positions count from 1
    return F.when(status.isNull(), "error").when((status == "needs_review") | (status == following) | past, "skip").when(status == required, "run").otherwise("error")


def finalised(candidates: DataFrame, rows: DataFrame, queue: DataFrame, failed: DataFrame, missing: DataFrame, invalid: DataFrame) -> DataFrame:
    """doc_id, schema_name, reason for each candidate (doc_id, schema_name, status): null where it may become done, else the first
    of: ``state`` (neither validated nor under review), ``empty`` (no row but inventories), ``pending`` (a latest row waits),
    ``queue`` (something is left to review), ``failed`` (a task failed), ``missing`` (a field was never produced), ``schema``.

    rows: doc_id, schema_name, field_path, status, the latest of each path; the others: doc_id, schema_name, any number of rows.
    """
    key = ["doc_id", "schema_name"]
    facts = rows.groupBy(*key).agg(F.count_if(~F.col("field_path").contains("$")).alias("__real"), F.count_if(F.col("status") == "pending").alias("__pending"))
    out = candidates.join(facts, key, "left")
    for name, part in (("queue", queue), ("failed", failed), ("missing", missing), ("schema", invalid)):
        out = out.join(part.select(*key).distinct().withColumn(f"__{name}", F.lit(True)), key, "left")
    reason = F.when(~F.col("status").isin("needs_review", "validated") | F.col("status").isNull(), "state").when(F.coalesce("__real", F.lit(0)) == 0, "empty").when(F.col("__pending") > 0, "pending")
    for name in ("queue", "failed", "missing", "schema"):
        reason = reason.when(F.col(f"__{name}").isNotNull(), name)
    return out.select(*key, reason.alias("reason"))


def routed(answers: DataFrame, required: list[str], pages: DataFrame) -> DataFrame:
    """What becomes of the tasks' answers: doc_id, task, status, error, and for tasks that are ok one row for each field with its page.

    answers: doc_id, task, task_page, error, fields (array<struct<field, page>>, null where the call failed). A failed call is a
    failed task; so is an answer that leaves out a required field, as an absence must be declared. A field's page is the one
    given if the file has it, else the task's, else the only page of a one-page file.
    """
    own = pages.groupBy("doc_id").agg(F.count("*").alias("__n"), F.min("page_no").alias("__only"))
    given = F.transform("fields", lambda f: f["field"])
    left_out = F.array_sort(F.array_except(F.array(*map(F.lit, required)), given))
    error = F.when(F.col("error").isNotNull() | F.col("fields").isNull(), F.coalesce(F.substring("error", 1, 500), F.lit("no answer"))).when(F.size(left_out) > 0, F.concat(F.lit("left out: "), F.array_join(left_out, ",")))
    rows = answers.withColumn("error", error).withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed"))
    wide = rows.withColumn("f", F.explode_outer(F.when(F.col("error").isNull(), F.col("fields")))).withColumn("page_no", F.col("f.page"))
    wide = wide.join(own, "doc_id", "left").join(pages.select("doc_id", "page_no").distinct().withColumn("__has", F.lit(True)), ["doc_id", "page_no"], "left")
    page = F.coalesce(F.when(F.col("__has"), F.col("page_no")), F.col("task_page"), F.when(F.col("__n") == 1, F.col("__only")))
    return wide.select("doc_id", "task", "status", "error", F.col("f.field").alias("field"), F.when(F.col("f.field").isNotNull(), page).alias("page"))

"""Runs with limited attempts, and plans of idempotent sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def attempts(events: DataFrame, key: str, order: list[str], limit: int = 2) -> DataFrame:
    """The decision at every ``run`` event of a job: ``decision`` and ``attempt``, in one pass over windows.

    ``events``: ``key, kind (run, success, fail, reset), recipe``. A reset (or the start) opens an epoch; inside it a run
    is REUSED if its recipe has succeeded, UNCHANGED_FAILURE if the event before was a failure of the same recipe,
    RETRY_LIMIT if ``limit`` runs came before, else RUN; ``attempt`` numbers the runs of the epoch.
    """
    w = Window.partitionBy(key).orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    epochs = events.withColumn("epoch", F.sum((F.col("kind") == "reset").cast("int")).over(so_far))
    e = Window.partitionBy(key, "epoch").orderBy(*order)
    r = Window.partitionBy(key, "epoch", "recipe").orderBy(*order)
    before = lambda win: win.rowsBetween(Window.unboundedPreceding, -1)
    named = epochs.withColumns(
        {
            "ran": F.coalesce(F.sum((F.col("kind") == "run").cast("int")).over(before(e)), F.lit(0)),
            "won": F.coalesce(F.max((F.col("kind") == "success").cast("int")).over(before(r)), F.lit(0)),
            "last_kind": F.lag("kind").over(e),
            "last_recipe": F.lag("recipe").over(e),
        }
    ).filter("kind = 'run'")
    decision = (
        F.when(F.col("won") == 1, "REUSED")
        .when((F.col("last_kind") == "fail") & (F.col("last_recipe") == F.col("recipe")), "UNCHANGED_FAILURE")
        .when(F.col("ran") >= limit, "RETRY_LIMIT")
        .otherwise("RUN")
    )
    return named.select(key, *order, "recipe", "epoch", (F.col("ran") + 1).alias("attempt"), decision.alias("decision"))


def latest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last event of each job; aggregates before the shuffle."""
    row = F.struct(*order, *[c for c in events.columns if c not in (*order, key)])
    return events.groupBy(key).agg(F.max(row).alias("r")).select(key, "r.*")


def attachment_plan(plan: DataFrame, records: DataFrame, key: str, source_key: str, file: str) -> DataFrame:
    """Status of each planned attachment before anything is sent.

    ``records``: ``key, sources array<string>, present array<string>``. SKIP_MISSING without the record or the file,
    SKIP_MISMATCH if no source name holds the source key, ALREADY if the name is there, else UPLOAD.
    """
    r = records.select(key, "sources", "present", F.lit(True).alias("__there"))
    found = F.exists(F.coalesce("sources", F.array().cast("array<string>")), lambda s: F.contains(s, F.col(source_key)))
    status = (
        F.when(F.col("__there").isNull() | F.col(file).isNull(), "SKIP_MISSING")
        .when(~found, "SKIP_MISMATCH")
        .when(F.array_contains(F.coalesce("present", F.array().cast("array<string>")), F.col(file)), "ALREADY")
        .otherwise("UPLOAD")
    )
    return plan.join(r, key, "left").select(*plan.columns, status.alias("status"))


def note_plan(notes: DataFrame, records: DataFrame, key: str, note: str, field: str, tag: str) -> DataFrame:
    """Records to change with their new text: the old text untouched, the tag and the note on a line of their own.

    Records that hold the tag already are left out, so a second run plans nothing.
    """
    old = F.coalesce(F.col(field), F.lit(""))
    new = F.concat(F.when(F.trim(old) != "", F.concat(old, F.lit("\n"))).otherwise(""), F.lit(tag), F.col(note))
    return notes.join(records.select(key, field), key).filter(~F.contains(old, F.lit(tag))).select(key, old.alias("old"), new.alias("new"))


def note_check(before: DataFrame, after: DataFrame, planned: DataFrame, key: str, field: str) -> DataFrame:
    """Planned records whose text is not the new one, or with any other column changed."""
    others = [c for c in before.columns if c not in (key, field)]
    a = before.select(key, F.struct(*others).alias("__a"))
    b = after.select(key, F.struct(*others).alias("__b"), F.col(field).alias("__now"))
    bad = ~F.col("__now").eqNullSafe(F.col("new")) | ~F.col("__a").eqNullSafe(F.col("__b"))
    return planned.join(a, key, "left").join(b, key, "left").filter(bad).select(key)


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is not done yet: survey runs resume by an anti-join on their own output."""
    return todo.join(done.select(key), key, "left_anti")


def finish(jobs: DataFrame, readings: DataFrame, gates: DataFrame, key: str) -> DataFrame:
    """``stage``: WAIT until the reading is READ, then FINAL_OK or FINAL_FAIL by the gate (FAIL without one)."""
    j = jobs.select(key).join(readings.select(key, F.col("status").alias("__s")), key, "left").join(gates.select(key, F.col("passed").alias("__p")), key, "left")
    return j.select(key, F.when(F.coalesce(F.col("__s"), F.lit("")) != "READ", "WAIT").when(F.coalesce("__p", F.lit(False)), "FINAL_OK").otherwise("FINAL_FAIL").alias("stage"))


def release(builds: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """``ready``: verified builds whose review passed and is bound to the same inventory and output digests."""
    r = reviews.select(key, F.col("inventory_sha256").alias("__i"), F.col("output_sha256").alias("__o"), F.col("verdict").alias("__v"))
    ok = F.col("verified") & (F.col("__v") == "PASS") & (F.col("inventory_sha256") == F.col("__i")) & (F.col("output_sha256") == F.col("__o"))
    return builds.join(r, key, "left").select(*builds.columns, F.coalesce(ok, F.lit(False)).alias("ready"))


def reservations(events: DataFrame, key: str, order: list[str], at: str, stale: float) -> DataFrame:
    """What becomes of each ``reserve`` and ``commit`` of a job: ``key, order..., kind, token, outcome``.

    Work is reserved under a token, done without a lock, and committed under the same token. A reservation is RUNNING if
    none is open or the open one is ``stale`` seconds old (``at``: seconds), else BUSY; a commit is DONE if its token is the open
    reservation's, which it closes, else LOST. One ordered fold per job, over the job's own events.
    """
    fields = [*order, "kind", "token", "at"]
    item = F.struct(*order, F.col("kind"), F.col("token"), F.col(at).cast("double").alias("at"))
    kinds = dict(events.select(*order, "kind", "token").dtypes)
    out_type = "array<struct<" + ",".join(f"{c}:{kinds[c]}" for c in [*order, "kind", "token"]) + ",outcome:string>>"
    start = F.struct(F.lit(None).cast("string").alias("open"), F.lit(None).cast("double").alias("since"), F.array().cast(out_type).alias("out"))

    def step(s, e):
        free = s["open"].isNull() | (e["at"] - s["since"] >= stale)
        takes, closes = (e["kind"] == "reserve") & free, (e["kind"] == "commit") & s["open"].eqNullSafe(e["token"]) & e["token"].isNotNull()
        outcome = F.when(e["kind"] == "reserve", F.when(free, "RUNNING").otherwise("BUSY")).otherwise(F.when(closes, "DONE").otherwise("LOST"))
        return F.struct(
            F.when(takes, e["token"]).when(closes, F.lit(None).cast("string")).otherwise(s["open"]).alias("open"),
            F.when(takes, e["at"]).when(closes, F.lit(None).cast("double")).otherwise(s["since"]).alias("since"),
            F.concat(s["out"], F.array(F.struct(*[e[c].alias(c) for c in fields[:-1]], outcome.alias("outcome")))).alias("out"),
        )

    per = events.filter(F.col("kind").isin("reserve", "commit")).groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("__e"))
    return per.select(key, F.inline(F.aggregate("__e", start, step, lambda s: s["out"])))


def audited_resets(requests: DataFrame, history: DataFrame, key: list[str], least: int = 12) -> DataFrame:
    """Each reset request with its ``status`` and the ``attempts`` it would clear (null unless RESET).

    ``requests``: ``key (record, source digest, ...), reason, operator``; ``history``: ``key, attempts``. A reset needs a reason of
    ``least`` characters without outer blanks, an operator, a plain record name, a SHA-256 and a history:
    REASON_TOO_SHORT, NO_OPERATOR, BAD_RECORD, BAD_DIGEST, NO_HISTORY, else RESET.
    """
    record, sha = key[0], key[1]
    blank = lambda c: F.coalesce(F.trim(c), F.lit(""))
    r = requests.join(history.select(*key, F.col("attempts").alias("__n")), key, "left")
    status = (
        F.when(F.length(blank("reason")) < least, "REASON_TOO_SHORT").when(blank("operator") == "", "NO_OPERATOR").when(~F.coalesce(F.col(record).rlike(r"^[A-Za-z0-9._-]+$"), F.lit(False)), "BAD_RECORD")
        .when(~F.coalesce(F.col(sha).rlike("^[0-9a-f]{64}$"), F.lit(False)), "BAD_DIGEST").when(F.col("__n").isNull(), "NO_HISTORY").otherwise("RESET")
    )
    return r.withColumn("status", status).select(*requests.columns, "status", F.when(F.col("status") == "RESET", F.col("__n")).alias("attempts"))

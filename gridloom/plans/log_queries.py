"""Registered queries over training logs and parameter tables, with their SQL."""

from pyspark.sql import functions as F

from gridloom.functions import pixels
from gridloom.operators import metrics, parameters, running
from gridloom.plans.views import LOG_SQL, params, table, train_log
from gridloom.sources import logs

QUERIES, ORACLE = {}, {}
ROW = ["run_id", "rank", "epoch", "batch_idx"]


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("q_epoch_loss", f"""WITH {LOG_SQL}
SELECT run_id, rank, epoch, count(*) AS n_batches, round(avg(loss), 6) AS epoch_loss FROM log GROUP BY ALL""")
def q_epoch_loss(spark, sf):
    return rounded(metrics.epoch_loss(train_log(spark, sf)), "epoch_loss")


@query("q_epoch_accuracy", f"""WITH {LOG_SQL}
SELECT run_id, rank, epoch, CAST(sum(n_correct) AS BIGINT) AS n_correct, CAST(sum(n_samples) AS BIGINT) AS n_samples,
       round(100.0::DOUBLE * sum(n_correct) / sum(n_samples), 6) AS epoch_accuracy FROM log GROUP BY run_id, rank, epoch""")
def q_epoch_accuracy(spark, sf):
    return rounded(metrics.epoch_accuracy(train_log(spark, sf)), "epoch_accuracy")


@query("q_reduce_ranks", f"""WITH {LOG_SQL}
SELECT run_id, count(DISTINCT rank) AS world, count(*) AS n_batches, round(sum(loss), 6) AS total_loss,
       CAST(sum(n_correct) AS BIGINT) AS n_correct, CAST(sum(n_samples) AS BIGINT) AS n_samples
FROM log GROUP BY run_id""")
def q_reduce_ranks(spark, sf):
    return rounded(metrics.reduce_ranks(train_log(spark, sf)), "total_loss")


@query("q_run_summary", f"""WITH {LOG_SQL},
last AS (SELECT run_id, max(epoch) AS last_epoch FROM log GROUP BY run_id),
ranks AS (SELECT run_id, epoch, rank, sum(loss) AS l, 100.0::DOUBLE * sum(n_correct) / sum(n_samples) AS acc
          FROM log GROUP BY ALL),
ending AS (SELECT run_id, last_epoch, avg(acc) AS final_accuracy, sum(l) / count(*) AS loss_last_by_world
           FROM ranks JOIN last USING (run_id) WHERE epoch = last_epoch GROUP BY ALL)
SELECT run_id, last_epoch, round(final_accuracy, 6) AS final_accuracy,
       round(sum(loss) / count(*) FILTER (rank = 0), 6) AS loss_by_rank0,
       round(loss_last_by_world, 6) AS loss_last_by_world, round(avg(loss), 6) AS loss_mean
FROM log JOIN ending USING (run_id) GROUP BY run_id, last_epoch, final_accuracy, loss_last_by_world""")
def q_run_summary(spark, sf):
    return rounded(
        metrics.run_summary(train_log(spark, sf)),
        "final_accuracy", "loss_by_rank0", "loss_last_by_world", "loss_mean",
    )


@query("q_run_duration", f"""WITH {LOG_SQL}
SELECT run_id, min(ts) AS started, max(ts) AS ended,
       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS seconds FROM log GROUP BY run_id""")
def q_run_duration(spark, sf):
    return metrics.run_duration(train_log(spark, sf))


RUNNING = "PARTITION BY run_id, rank, epoch ORDER BY batch_idx ROWS UNBOUNDED PRECEDING"
RUNNING_RANK = "PARTITION BY run_id, rank ORDER BY epoch, batch_idx ROWS UNBOUNDED PRECEDING"


@query("q_running_accuracy", f"""WITH {LOG_SQL}
SELECT run_id, rank, epoch, batch_idx, round(100.0::DOUBLE * sum(n_correct) OVER w / sum(n_samples) OVER w, 6) AS accuracy
FROM log WINDOW w AS ({RUNNING})""")
def q_running_accuracy(spark, sf):
    return rounded(running.running_accuracy(train_log(spark, sf)).select(*ROW, "accuracy"), "accuracy")


@query("q_running_loss", f"""WITH {LOG_SQL}
SELECT run_id, rank, epoch, batch_idx, round(sum(loss) OVER w, 6) AS total_loss, count(*) OVER w AS total_batches
FROM log WINDOW w AS ({RUNNING_RANK})""")
def q_running_loss(spark, sf):
    totals = running.running_loss(train_log(spark, sf))
    return rounded(totals.select(*ROW, "total_loss", "total_batches"), "total_loss")


@query("q_smooth_loss", f"""WITH {LOG_SQL},
prefix AS (SELECT run_id, rank, epoch, batch_idx, list(loss) OVER ({RUNNING_RANK}) AS l FROM log)
SELECT run_id, rank, epoch, batch_idx,
       round(list_reduce(list_prepend(0.0::DOUBLE, l), lambda s, x: 0.1::DOUBLE * x + 0.9::DOUBLE * s), 6) AS smoothed
FROM prefix""")
def q_smooth_loss(spark, sf):
    return rounded(running.smooth_loss(train_log(spark, sf), 0.1).select(*ROW, "smoothed"), "smoothed")


CURVE_SQL = f"""{LOG_SQL},
batches AS (SELECT run_id, rank, epoch, batch_idx, loss, 'batch' AS kind,
              round(100.0::DOUBLE * sum(n_correct) OVER w / sum(n_samples) OVER w, 6) AS accuracy
            FROM log WINDOW w AS ({RUNNING})),
repeats AS (SELECT run_id, rank, epoch, max(batch_idx) + 1 AS batch_idx, NULL::DOUBLE AS loss, 'epoch' AS kind,
              arg_max(accuracy, batch_idx) AS accuracy FROM batches GROUP BY run_id, rank, epoch)"""


@query("q_curves", f"""WITH {CURVE_SQL}
SELECT *, row_number() OVER (PARTITION BY run_id, rank ORDER BY epoch, batch_idx) - 1 AS point FROM batches""")
def q_curves(spark, sf):
    return rounded(running.curves(train_log(spark, sf)), "accuracy")


@query("q_curves_repeat", f"""WITH {CURVE_SQL}, points AS (FROM batches UNION ALL BY NAME FROM repeats)
SELECT *, row_number() OVER (PARTITION BY run_id, rank ORDER BY epoch, batch_idx, kind) - 1 AS point FROM points""")
def q_curves_repeat(spark, sf):
    return rounded(running.curves(train_log(spark, sf), repeat_epoch_point=True), "accuracy")


@query("q_progress_every_k", f"""WITH {LOG_SQL}
SELECT run_id, rank, epoch, batch_idx, n_samples, loss FROM log WHERE batch_idx % 50 = 0""")
def q_progress_every_k(spark, sf):
    return running.progress_rows(train_log(spark, sf), 50).select(*ROW, "n_samples", "loss")


@query("q_log_parse", f"""WITH {LOG_SQL}
SELECT batch_idx AS line, 'batch' AS kind, rank, epoch, batch_idx, NULL::INTEGER AS n_samples, loss,
       NULL::DOUBLE AS accuracy FROM log
UNION ALL
SELECT batch_idx, 'epoch', rank, epoch, NULL, NULL, loss, n_correct::DOUBLE FROM log""")
def q_log_parse(spark, sf):
    log = train_log(spark, sf)
    head = F.concat(F.lit("2024-01-01 00:00:00,000 - INFO - Rank "), "rank")
    text = F.array(
        F.concat(head, F.lit(", Epoch "), "epoch", F.lit(", Batch "), "batch_idx", F.lit(", Loss "), "loss"),
        F.concat(
            head, F.lit(" - Epoch "), "epoch", F.lit(", Loss "), "loss", F.lit(", Accuracy "), "n_correct", F.lit(".00%")
        ),
        F.concat(F.lit("training goes on after "), "batch_idx"),
    )
    return logs.parse_training_log(log.select(F.col("batch_idx").alias("line"), F.explode(text).alias("value")))


@query("q_checkpoint_resume", f"""WITH {LOG_SQL},
saved AS (SELECT run_id, epoch, CASE WHEN min(loss) > 0.2 THEN NULL ELSE max(loss) END AS loss FROM log
          GROUP BY run_id, epoch)
SELECT run_id, max(epoch) AS saved_epoch, coalesce(arg_max_null(loss, epoch), 0.0::DOUBLE) AS loss,
       max(epoch) + 1 AS start_epoch FROM saved GROUP BY run_id""")
def q_checkpoint_resume(spark, sf):
    saved = train_log(spark, sf).groupBy("run_id", "epoch").agg(
        F.when(F.min("loss") > 0.2, None).otherwise(F.max("loss")).alias("loss")
    )
    return metrics.latest_checkpoint(saved)


@query("q_version_name", """
SELECT event_id, 'model_checkpoint_' || strftime(ts, '%Y%m%d_%H%M%S') || '.pth' AS version FROM events""")
def q_version_name(spark, sf):
    return table(spark, sf, "events").select("event_id", pixels.version_name(F.col("ts")).alias("version"))


TENSORS_SQL = """tensors AS (
  SELECT CAST(vec_id // 4 AS VARCHAR) AS name, vec_id % 4 AS rank, embedding AS vals FROM embeddings)"""


@query("q_param_summary", f"""WITH {TENSORS_SQL}
SELECT name, count(*) AS n_tensors, CAST(sum(len(vals)) AS BIGINT) AS n_params FROM tensors GROUP BY ROLLUP (name)""")
def q_param_summary(spark, sf):
    return parameters.param_summary(params(spark, sf))


@query("q_replica_check", f"""WITH {TENSORS_SQL},
cells AS (SELECT name, rank, unnest(vals)::DOUBLE AS v, unnest(range(len(vals))) AS pos FROM tensors),
pairs AS (SELECT c.name, c.pos, abs(b.v - c.v) AS gap, abs(b.v - c.v) <= 0.45::DOUBLE + 1e-5::DOUBLE * abs(c.v) AS near
          FROM cells c JOIN cells b ON b.name = c.name AND b.pos = c.pos AND b.rank = 0)
SELECT name, count(DISTINCT pos) AS n_elements, CAST(count(*) / count(DISTINCT pos) AS BIGINT) AS n_replicas,
       round(max(gap), 6) AS max_gap, bool_and(near) AS consistent FROM pairs GROUP BY name""")
def q_replica_check(spark, sf):
    return rounded(parameters.replica_check(params(spark, sf), atol=0.45), "max_gap")

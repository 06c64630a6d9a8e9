"""Queries on prompt scores and tile labels.

Images are all embeddings; the prompt bank holds, for each label and remainder
of vec_id by three, the component-wise maximum: 30 prompts at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators import labels, semantic
from rasterloom.plans.registry import Registry
from rasterloom.session import table, written

REGISTRY = Registry()
query = REGISTRY.query
_NAMES = [d for ds in semantic.DETAILED.values() for d in ds]
_DETAILED = str(_NAMES)
_CLASSES = str(list(semantic.CLASSES))
_OF = "map {" + ", ".join(f"'{d}': '{c}'" for c, ds in semantic.DETAILED.items() for d in ds) + "}"
_ORDER = "coalesce(list_position(" + _CLASSES + ", class), 9)"

_LOGITS = f"""WITH images AS (SELECT vec_id AS image_id, embedding::double[] AS vector FROM embeddings),
  flat AS (SELECT label * 3 + vec_id % 3 AS prompt_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::double AS x FROM embeddings),
  best AS (SELECT prompt_id, pos, max(x) AS x FROM flat GROUP BY 1, 2),
  prompts AS (SELECT prompt_id, list(x ORDER BY pos) AS p FROM best GROUP BY 1),
  logits AS (SELECT image_id, prompt_id, {_CLASSES}[(prompt_id % 8 + 1)::integer] AS class, {_DETAILED}[(prompt_id % 27 + 1)::integer] AS detailed,
    100 * list_cosine_similarity(vector, p) AS logit FROM images, prompts)"""
_TOP = _LOGITS + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY image_id, class ORDER BY logit DESC) AS n FROM logits),
  cl AS (SELECT image_id, class, avg(logit) AS logit FROM ranked WHERE n <= 2 GROUP BY 1, 2),
  sm AS (SELECT image_id, class, exp((logit - max(logit) OVER (PARTITION BY image_id)) / 10) AS e FROM cl), p AS (SELECT image_id, class, e / sum(e) OVER (PARTITION BY image_id) AS p FROM sm)"""
_DETAIL = _TOP + f""", dl AS (SELECT image_id, detailed, max(logit) AS logit FROM logits GROUP BY 1, 2), de AS (SELECT *, exp((logit - max(logit) OVER (PARTITION BY image_id)) / 10) AS e FROM dl),
  dp AS (SELECT image_id, detailed, {_OF}[detailed] AS class, e / sum(e) OVER (PARTITION BY image_id) AS p FROM de)"""


def _collapsed(how: str, source: str = "dp") -> str:
    return f", co AS (SELECT image_id, class, s / sum(s) OVER (PARTITION BY image_id) AS p FROM (SELECT image_id, class, {how}(p) AS s FROM {source} GROUP BY 1, 2))"


_TWO = f""", rk AS (SELECT image_id, class, p, row_number() OVER (PARTITION BY image_id ORDER BY p DESC, {_ORDER}, class) AS n FROM co),
  tt AS (SELECT image_id, max(CASE WHEN n = 1 THEN class END) AS top_class, max(CASE WHEN n = 1 THEN p END) AS top_score, coalesce(max(CASE WHEN n = 2 THEN class END), 'none') AS second_class, coalesce(max(CASE WHEN n = 2 THEN p END), 0) AS second_score FROM rk GROUP BY 1)"""
# Spelled out here, so that a wrong value in the operators is told.
_THRESHOLDS = """(VALUES ('structures', 0.50, 0.08, 0.38), ('roads', 0.42, 0.06, 0.40), ('vehicle_tracks', 0.42, 0.06, 0.38), ('trees', 0.60, 0.07, 0.40),
  ('grass', 0.45, 0.05, 0.42), ('dirt', 0.45, 0.05, 0.42), ('crops', 0.60, 0.06, 0.40), ('debris', 0.60, 0.04, 0.42)) AS th(class, min_score, min_margin, max_second)"""


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("embedding").cast("array<double>").alias("vector"))


def _pick(names: list[str], n: Column) -> Column:
    return F.get(F.array(*(F.lit(x) for x in names)), n.cast("int"))


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "embeddings").select((F.col("label") * 3 + F.col("vec_id") % 3).alias("prompt_id"), F.posexplode("embedding").alias("pos", "x"))
    best = flat.groupBy("prompt_id", "pos").agg(F.max("x").cast("double").alias("x"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"])
    bank = best.groupBy("prompt_id").agg(ordered.alias("vector"))
    return bank.withColumns({"class": _pick(list(semantic.CLASSES), F.col("prompt_id") % 8), "detailed": _pick(_NAMES, F.col("prompt_id") % 27)})


def _logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = _prompts(spark, sf_dir)
    logits = semantic.prompt_logits(_images(spark, sf_dir), prompts)
    return logits.join(F.broadcast(prompts.select("prompt_id", "detailed")), "prompt_id")


def _coarse(logits: DataFrame) -> DataFrame:
    return semantic.softmax(semantic.class_logits(logits, 2).withColumn("logit", F.col("logit") / 10))


def _detailed(logits: DataFrame) -> DataFrame:
    top = semantic.class_logits(logits.drop("class").withColumnRenamed("detailed", "class"), 1)
    return semantic.softmax(top.withColumn("logit", F.col("logit") / 10)).withColumnRenamed("class", "detailed")


def _round(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("q_l2_normalize", """WITH v AS (SELECT vec_id, embedding::double[] AS e FROM embeddings), u AS (SELECT vec_id, unnest(range(0, len(e))) AS pos, unnest(e) / sqrt(list_sum(list_transform(e, lambda x: x * x))) AS x FROM v)
  SELECT vec_id AS image_id, pos::integer AS pos, round(x, 6) AS x FROM u""")
def q_l2_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_images(spark, sf_dir).select("image_id", F.posexplode(semantic.l2_normalize(F.col("vector"))).alias("pos", "x")), "x")


@query("q_prompt_logits", _LOGITS + " SELECT image_id, prompt_id, class, round(logit, 6) AS logit FROM logits")
def q_prompt_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(semantic.prompt_logits(_images(spark, sf_dir), _prompts(spark, sf_dir)), "logit")


@query("q_topk_mean_logits", _TOP + " SELECT image_id, class, round(logit, 6) AS logit FROM cl")
def q_topk_mean_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(semantic.class_logits(_logits(spark, sf_dir), 2), "logit")


@query("q_softmax", _TOP + " SELECT image_id, class, round(p, 6) AS p FROM p")
def q_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_coarse(_logits(spark, sf_dir)), "p")


@query("q_collapse_max", _DETAIL + _collapsed("max") + " SELECT image_id, class, round(p, 6) AS p FROM co")
def q_collapse_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(semantic.collapse(_detailed(_logits(spark, sf_dir)), semantic.detailed_table(spark), "max"), "p")


@query("q_collapse_sum", _DETAIL + _collapsed("sum") + " SELECT image_id, class, round(p, 6) AS p FROM co")
def q_collapse_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(semantic.collapse(_detailed(_logits(spark, sf_dir)), semantic.detailed_table(spark), "sum"), "p")


def _final(spark: SparkSession, sf_dir: str, how: str = "max") -> DataFrame:
    return semantic.collapse(_detailed(_logits(spark, sf_dir)), semantic.detailed_table(spark), how)


@query("q_stable_rank", _DETAIL + _collapsed("max") + _TWO + " SELECT image_id, class, n::integer AS rank FROM rk")
def q_stable_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.stable_rank(_final(spark, sf_dir)).select("image_id", "class", "rank")


@query("q_margin", _DETAIL + _collapsed("max") + _TWO + " SELECT image_id, top_class, round(top_score, 6) AS top_score, second_class, round(second_score, 6) AS second_score, round(top_score - second_score, 6) AS margin FROM tt")
def q_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(semantic.top_two(_final(spark, sf_dir)), "top_score", "second_score", "margin")


_TRIAGE = _DETAIL + _collapsed("max") + _TWO + f""", dr AS (SELECT image_id, class, p, row_number() OVER (PARTITION BY image_id ORDER BY p DESC, {_ORDER}, class, detailed) AS n FROM dp),
  dt AS (SELECT image_id, max(CASE WHEN n = 1 THEN class END) AS dc, max(CASE WHEN n = 1 THEN p END) AS ds, max(CASE WHEN n = 1 THEN p END) - coalesce(max(CASE WHEN n = 2 THEN p END), 0) AS dm FROM dr GROUP BY 1),
  x AS (SELECT tt.*, top_score - second_score AS margin, dc, ds, dm, min_score, min_margin, max_second FROM tt JOIN dt USING (image_id) LEFT JOIN {_THRESHOLDS} ON th.class = top_class),
  y AS (SELECT *, top_score < 0.26 AS weak, top_score < 0.34 AND margin < 0.02 AS tied FROM x),
  z AS (SELECT image_id, top_class, top_score, second_class, second_score, margin, NOT (weak OR tied) AS accepted, CASE WHEN weak OR tied THEN 'review' ELSE top_class END AS bucket,
    CASE WHEN weak OR tied THEN 'review' WHEN coalesce(top_score >= min_score AND margin >= min_margin AND second_score <= max_second AND ds >= 0.26 AND dm >= 0.04 AND dc = top_class, false) THEN 'high'
      WHEN top_score >= 0.38 OR margin >= 0.035 THEN 'medium' ELSE 'low' END AS confidence,
    CASE WHEN weak OR tied THEN top_score ELSE (top_score + greatest(margin, 0)) / 2 END AS confidence_score,
    CASE WHEN weak THEN 'true_edge_low_evidence' WHEN tied THEN 'true_edge_weak_tie' ELSE 'real_class_assigned' END AS reason, coalesce(dc = top_class, false) AS detail_agrees FROM y)"""


def _triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    logits = written(_logits(spark, sf_dir), "logits")
    detailed = _detailed(logits)
    tops = semantic.top_two(semantic.collapse(detailed, semantic.detailed_table(spark)))
    details = detailed.join(F.broadcast(semantic.detailed_table(spark)), "detailed").select("image_id", "class", "p")
    return semantic.triage(tops, semantic.top_two(details), semantic.threshold_table(spark))


@query("q_triage_decision", _TRIAGE + " SELECT image_id, accepted, bucket, reason, round(confidence_score, 6) AS confidence_score FROM z")
def q_triage_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(_triaged(spark, sf_dir).select("image_id", "accepted", "bucket", "reason", "confidence_score"), "confidence_score")


@query("q_confidence", _TRIAGE + " SELECT image_id, top_class, confidence, detail_agrees FROM z")
def q_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triaged(spark, sf_dir).select("image_id", "top_class", "confidence", "detail_agrees")


@query("q_semantic_label", _TRIAGE + " SELECT bucket, confidence, count(*) AS n, round(avg(top_score), 6) AS mean_top FROM z GROUP BY 1, 2")
def q_semantic_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triaged(spark, sf_dir).groupBy("bucket", "confidence").agg(F.count("*").alias("n"), F.round(F.avg("top_score"), 6).alias("mean_top"))


@query("q_prefer_structures", _DETAIL + _collapsed("sum") + f""", t AS (SELECT image_id, class AS tc, p AS tp FROM co QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY p DESC, {_ORDER}, class DESC) = 1),
  s AS (SELECT image_id, coalesce(max(CASE WHEN class = 'structures' THEN p END), 0) AS sp FROM co GROUP BY 1),
  w AS (SELECT image_id, class, CASE WHEN tc IN ('roads', 'tracks', 'dirt', 'shadow', 'mixed') AND sp >= 0.1 AND tp - sp <= 0.3 THEN CASE class WHEN 'structures' THEN tp + 0.001::double WHEN tc THEN greatest(0, sp - 0.001::double) ELSE p END ELSE p END AS q
    FROM co JOIN t USING (image_id) JOIN s USING (image_id))
  SELECT image_id, class, round(q / sum(q) OVER (PARTITION BY image_id), 6) AS p FROM w""")
def q_prefer_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(semantic.prefer_structures(_final(spark, sf_dir, "sum"), margin=0.3, least=0.1), "p")


@query("q_mostly_hybrid", _DETAIL + _collapsed("sum") + _TWO + """ SELECT image_id, top_score < 0.4 OR second_score >= 0.2 AS mixed,
  CASE WHEN NOT (top_score < 0.4 OR second_score >= 0.2) THEN 'mostly_' || top_class WHEN second_score >= 0.2 THEN 'hybrid_' || top_class || '_' || second_class ELSE 'mixed' END AS bucket FROM tt""")
def q_mostly_hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.mostly_bucket(semantic.top_two(_final(spark, sf_dir, "sum")), 0.4, 0.2).select("image_id", "mixed", "bucket")


_LABELS = _TRIAGE + """, l AS (SELECT image_id AS tile_id, 'S' || image_id // 100 AS shard, CASE WHEN image_id % 4 <> 0 THEN bucket ELSE 'shards' END AS label, 'shards' AS bucket,
  CASE WHEN image_id % 4 <> 0 THEN top_class ELSE '' END AS dominant, CASE WHEN image_id % 4 <> 0 THEN confidence ELSE '' END AS confidence, CASE WHEN image_id % 4 <> 0 THEN top_class ELSE '' END AS top_class,
  CASE WHEN image_id % 4 <> 0 THEN second_class ELSE '' END AS second_class, round(CASE WHEN image_id % 4 <> 0 THEN confidence_score ELSE 0 END, 6) AS confidence_score,
  round(CASE WHEN image_id % 4 <> 0 THEN top_score ELSE 0 END, 6) AS top_score, round(CASE WHEN image_id % 4 <> 0 THEN second_score ELSE 0 END, 6) AS second_score,
  round(CASE WHEN image_id % 4 <> 0 THEN margin ELSE 0 END, 6) AS margin, CASE WHEN image_id % 4 <> 0 THEN reason ELSE '' END AS review_reasons FROM z)"""


def _label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _triaged(spark, sf_dir)
    payload = F.struct(
        "bucket", F.col("top_class").alias("dominant"), "confidence", "top_class", "second_class", *(F.round(c, 6).alias(c) for c in labels.NUMBERS), F.array("reason").alias("reasons")
    )
    tiles = rows.select(
        F.col("image_id").alias("tile_id"), F.concat(F.lit("S"), F.expr("cast(image_id div 100 as string)")).alias("shard"), F.lit("shards").alias("bucket"),
        F.when(F.col("image_id") % 4 != 0, payload).alias("semantic"),
    )
    return labels.label_rows(tiles)


@query("q_label_rows", _LABELS + " SELECT * FROM l")
def q_label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_rows(spark, sf_dir)


@query("q_sidecar_split", _LABELS + f""" SELECT tile_id, CASE WHEN label IN ({', '.join(repr(c) for c in semantic.CLASSES)}) THEN 'labels' ELSE 'review' END AS sidecar, CASE WHEN label IN ({', '.join(repr(c) for c in semantic.CLASSES)}) THEN bucket ELSE 'review' END AS bucket FROM l""")
def q_sidecar_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, review = labels.sidecars(written(_label_rows(spark, sf_dir), "label-rows"))
    return kept.select("tile_id", F.lit("labels").alias("sidecar"), "bucket").unionByName(review.select("tile_id", F.lit("review").alias("sidecar"), "bucket"))


@query("q_triage_reasons", _TRIAGE + """ SELECT image_id, bucket, CASE WHEN reason = 'true_edge_low_evidence' THEN format('true_edge_low_evidence:{:.4f}<0.2600', top_score)
  WHEN reason = 'true_edge_weak_tie' THEN format('true_edge_weak_tie:score={:.4f}<0.3400,margin={:.4f}<0.0200', top_score, margin) ELSE reason END AS reasons FROM z""")
def q_triage_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw scores to decisions whose reasons carry the numbers."""
    logits = written(_logits(spark, sf_dir), "logits")
    detailed = _detailed(logits)
    scores = semantic.collapse(detailed, semantic.detailed_table(spark))
    details = detailed.join(F.broadcast(semantic.detailed_table(spark)), "detailed").select("image_id", "class", "p")
    return semantic.decide(scores, details, semantic.threshold_table(spark)).select("image_id", "bucket", F.array_join("reasons", "|").alias("reasons"))


@query("q_class_score", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN least(1, p_size / 40) WHEN p_partkey % 3 = 1 THEN 0.75 ELSE 0 END::double AS debris FROM part""")
def q_class_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the map where it has the class, else from the top class."""
    n = F.col("p_partkey") % 3
    scores = F.when(n == 0, F.create_map(F.lit("debris"), F.col("p_size") / 40)).otherwise(F.create_map(F.lit("roads"), F.lit(0.9)))
    top = F.when(n == 1, "debris").otherwise("roads")
    return table(spark, sf_dir, "part").select("p_partkey", semantic.class_score(scores, top, F.lit(0.75), "debris").alias("debris"))

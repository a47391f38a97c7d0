"""Headlines, prompts, parsed answers and the explanation table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import text
from tidemark.operators import explain, metrics
from tidemark.plans.detection import anomaly_ctes, hourly_anomalies
from tidemark.plans.registry import query, settle, settle_sql
from tidemark.session import scratch_dir
from tidemark.sources import market
from tidemark.streaming import jobs

_HEADLINES = r"""pages_of AS (
  SELECT page_id, page_id // 50 AS feed_seq,
         CASE regexp_extract(html, '<html lang="([a-z]*)"', 1) WHEN 'en' THEN 'BTC' WHEN 'fr' THEN 'ETH'
              WHEN 'de' THEN 'SOL' ELSE 'XRP' END AS asset,
         trim(replace(replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1),
              '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS title
  FROM pages),
newest AS (SELECT asset, max(feed_seq) AS feed_seq FROM pages_of GROUP BY asset),
titles AS (
  SELECT asset, title, row_number() OVER (PARTITION BY asset ORDER BY page_id) AS pos
  FROM pages_of JOIN newest USING (asset, feed_seq) WHERE title <> ''),
headlines AS (SELECT asset, pos, title FROM titles WHERE pos <= 5)"""


def _news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.headlines(market.headline_feeds(spark, sf_dir))


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly anomalies, detected when their candle's window starts."""
    return hourly_anomalies(spark, sf_dir).withColumn("detected_at", F.col("candle_window_start"))


def _template_answers(prompted: DataFrame) -> DataFrame:
    """A fixed answer built from the prompt's own lines: what stands for a language model here."""
    subject = F.split_part("prompt", F.lit("\n"), F.lit(2))
    answer = F.to_json(F.struct(
        F.concat_ws(" ", "symbol", subject).alias("explanation"), F.array("anomaly_type").alias("key_factors")
    ))
    words = lambda c: F.size(F.split(c, r"\s+"))
    return prompted.withColumns({
        "text": answer,
        "prompt_tokens": words(F.col("prompt")),
        "completion_tokens": words(F.col("prompt")) + 1,
        "error_kind": F.lit(None).cast("string"),
    })


@query("headlines", f"WITH {_HEADLINES} SELECT asset, CAST(pos AS INT) AS pos, title FROM headlines")
def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _news(spark, sf_dir).select("asset", F.posexplode("news_headlines").alias("pos", "title")).withColumn(
        "pos", F.col("pos") + 1
    )


_PROMPTS = f"""{anomaly_ctes()}, {_HEADLINES},
news AS (
  SELECT asset, string_agg('  ' || pos || '. ' || title, chr(10) ORDER BY pos) AS lines FROM headlines GROUP BY asset),
prompts AS (
  SELECT a.*, 'Anomalia detectada em ' || symbol || ' (' || candle_interval || ') as '
         || strftime(candle_window_start, '%Y-%m-%d %H:%M:%S UTC') || ':' || chr(10)
         || 'Tipo: ' || anomaly_type || ' — '
         || CASE anomaly_type
              WHEN 'PRICE_SPIKE' THEN format('variacao de preco de {{:.2f}}% (close={{:.4f}}, anterior={{:.4f}})',
                                             severity * 100, current_value, baseline_value)
              WHEN 'VOLUME_SPIKE' THEN format('pico de volume z-score={{:.2f}} (volume={{:.2f}}, media={{:.2f}})',
                                              severity, current_value, baseline_value)
              ELSE format('pico de volatilidade z-score={{:.2f}} (range={{:.4f}}, media={{:.4f}})',
                          severity, current_value, baseline_value) END
         || coalesce(chr(10) || chr(10) || 'Noticias recentes relacionadas:' || chr(10) || lines, '')
         || chr(10) || chr(10) || 'Explique esta anomalia conforme as instrucoes.' AS prompt
  FROM anomalies a LEFT JOIN news n ON n.asset = split_part(a.symbol, '-', 1))"""


@query("prompts", f"WITH {_PROMPTS} SELECT anomaly_id, prompt FROM prompts")
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.with_prompts(_anomalies(spark, sf_dir), _news(spark, sf_dir)).select("anomaly_id", "prompt")


@query("parsed_responses", r"""
WITH shaped AS (SELECT doc_id, text, source, lang IN ('en', 'de') AS is_json FROM documents)
SELECT doc_id, md5(CASE WHEN is_json THEN text ELSE regexp_replace(text, '^\s+|\s+$', '', 'g') END) AS explanation_md5,
       CASE WHEN is_json THEN 2 ELSE 0 END AS factors, CASE WHEN is_json THEN source END AS first_factor
FROM shaped""")
def parsed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as answers: English as JSON, German as fenced JSON, others as plain text."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    body = F.to_json(F.struct(F.col("text").alias("explanation"), F.array("source", "lang").alias("key_factors")))
    answer = (
        F.when(F.col("lang") == "en", body)
        .when(F.col("lang") == "de", F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .otherwise(F.col("text"))
    )
    parsed = documents.select("doc_id", text.parse_answer(answer).alias("answer"))
    return parsed.select(
        "doc_id",
        F.md5("answer.explanation").alias("explanation_md5"),
        F.size("answer.key_factors").alias("factors"),
        F.get("answer.key_factors", F.lit(0)).alias("first_factor"),
    )


_AT = "2024-02-01 00:00:00"


def _saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompted = explain.with_prompts(_anomalies(spark, sf_dir), _news(spark, sf_dir))
    return explain.saves_of(_template_answers(prompted), "template", F.lit(_AT).cast("timestamp"))


_EXPLAINED = f"""{_PROMPTS},
explained AS (
  SELECT *, symbol || ' ' || split_part(prompt, chr(10), 2) AS explanation,
         len(regexp_split_to_array(prompt, '\\s+')) AS prompt_tokens FROM prompts)"""


@query("explanations", f"""WITH {_EXPLAINED}
SELECT e.anomaly_id, symbol, anomaly_type, candle_window_start AS detected_at, candle_window_start, candle_interval,
       explanation, anomaly_type AS factors,
       coalesce((SELECT string_agg(title, ' | ' ORDER BY pos) FROM headlines h
                 WHERE h.asset = split_part(e.symbol, '-', 1)), '') AS news,
       'template' AS model_used, TIMESTAMP '2024-02-01 00:00:00' AS explained_at,
       {settle_sql('severity')} AS severity, {settle_sql('current_value')} AS current_value,
       {settle_sql('baseline_value')} AS baseline_value,
       CAST(prompt_tokens AS INT) AS prompt_tokens, CAST(prompt_tokens + 1 AS INT) AS completion_tokens
FROM explained e""")
def explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explanation table after every anomaly was saved pending and then explained."""
    table = explain.upsert_explanations(_saves(spark, sf_dir))
    return table.select(
        "anomaly_id", "symbol", "anomaly_type", "detected_at", "candle_window_start", "candle_interval",
        "explanation", F.array_join("key_factors", " | ").alias("factors"),
        F.array_join("news_headlines", " | ").alias("news"), "model_used", "explained_at",
        *[settle(F.col(n)).alias(n) for n in ("severity", "current_value", "baseline_value")], "prompt_tokens", "completion_tokens",
    )


@query("pending_records", f"""WITH {anomaly_ctes()}
SELECT anomaly_id, symbol, anomaly_type, candle_interval, CAST(NULL AS VARCHAR) AS explanation,
       0 AS factors, 0 AS headlines, CAST(NULL AS TIMESTAMP) AS explained_at FROM anomalies""")
def pending_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.pending(_anomalies(spark, sf_dir)).select(
        "anomaly_id", "symbol", "anomaly_type", "candle_interval", "explanation",
        F.size("key_factors").alias("factors"), F.size("news_headlines").alias("headlines"), "explained_at",
    )


@query("explanation_accounting", f"""WITH {_EXPLAINED}
SELECT symbol, anomaly_type, count(*) AS explained, CAST(0 AS BIGINT) AS pending,
       CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(prompt_tokens + 1) AS BIGINT) AS completion_tokens
FROM explained GROUP BY symbol, anomaly_type""")
def explanation_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = explain.upsert_explanations(_saves(spark, sf_dir))
    return metrics.explanation_accounting(table)


@query("explanation_errors", f"""WITH {anomaly_ctes()}
SELECT CASE WHEN anomaly_type = 'PRICE_SPIKE' THEN 'api_error' ELSE 'unexpected' END AS error_kind, count(*) AS errors
FROM anomalies WHERE anomaly_type <> 'VOLUME_SPIKE' GROUP BY ALL""")
def explanation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of a completion function that can only answer requests about volume."""

    def complete(prompt):
        import pandas as pd

        price = prompt.str.contains("Tipo: PRICE_SPIKE")
        volume = prompt.str.contains("Tipo: VOLUME_SPIKE")
        kind = pd.Series("unexpected", index=prompt.index).mask(price, "api_error").mask(volume, None)
        return pd.DataFrame({"text": prompt.where(volume, None), "error_kind": kind})

    return metrics.explanation_errors(explain.answers(_anomalies(spark, sf_dir), _news(spark, sf_dir), complete))


@query("explained_stream", f"""WITH {anomaly_ctes()}
SELECT anomaly_id, symbol, anomaly_type, CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN symbol END AS explanation,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN 'model' END AS model_used,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN TIMESTAMP '{_AT}' END AS explained_at,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN 7 END AS prompt_tokens FROM anomalies""")
def explained_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explanation job on a stream of anomalies; requests about volume raise and stay pending."""
    base = scratch_dir(spark, "explain")
    anomalies = _anomalies(spark, sf_dir)
    anomalies.repartition(4).write.parquet(f"{base}/anomalies")
    stream = spark.readStream.schema(anomalies.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/anomalies")

    def complete(prompt):
        import pandas as pd

        if prompt.str.contains("Tipo: VOLUME_SPIKE").any():
            raise ValueError("no answer about volume")
        return pd.DataFrame({"text": prompt.str.extract(r"em (\S+) ")[0], "prompt_tokens": 7})

    jobs.start_explanations(
        stream, _news(spark, sf_dir), complete, "model", f"{base}/saves", f"{base}/checkpoint",
        at=F.lit(_AT).cast("timestamp"), bounded=True,
    ).awaitTermination()
    table = explain.upsert_explanations(spark.read.parquet(f"{base}/saves"))
    return table.select("anomaly_id", "symbol", "anomaly_type", "explanation", "model_used", "explained_at", "prompt_tokens")


@query("explanation_store", f"""WITH {_EXPLAINED}
SELECT anomaly_id, symbol, anomaly_type, candle_window_start AS detected_at,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN explanation END AS explanation,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN anomaly_type ELSE '' END AS factors,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN 'template' END AS model_used,
       CASE WHEN anomaly_type <> 'VOLUME_SPIKE' THEN CAST(prompt_tokens AS INT) END AS prompt_tokens
FROM explained""")
def explanation_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store that a stream of saves fills: all pending, then all explained, then those about volume pending once more."""
    base, log = scratch_dir(spark, "store"), scratch_dir(spark, "saves")
    _saves(spark, sf_dir).write.parquet(log)
    saves = spark.read.parquet(log)
    volume = F.col("anomaly_type") == "VOLUME_SPIKE"
    for n, part in enumerate(("seq = 0", "seq = 1", (F.col("seq") == 0) & volume)):
        saves.filter(part).write.parquet(f"{base}/saves/n={n}")
        stream = spark.readStream.schema(saves.schema).parquet(f"{base}/saves/n=*")
        jobs.start_explanation_store(stream, f"{base}/store", f"{base}/checkpoint", bounded=True).awaitTermination()
    return explain.read_explanations(spark, f"{base}/store").select(
        "anomaly_id", "symbol", "anomaly_type", "detected_at", "explanation", F.array_join("key_factors", " | ").alias("factors"),
        "model_used", "prompt_tokens",
    )

"""Explanations of anomalies: headlines, requests, answers, and the table that keeps them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark import schemas
from tidemark.functions import text
from tidemark.functions.indicators import base_asset
from tidemark.operators import keyed

# Answers for a series of prompts: a frame with text, prompt_tokens, completion_tokens, error_kind.
Complete = Callable[[pd.Series], pd.DataFrame]

_ANSWERED = ("explanation", "key_factors", "news_headlines", "model_used", "explained_at",
             "prompt_tokens", "completion_tokens")
_DETECTED = tuple(n for n in schemas.EXPLANATION.fieldNames() if n not in _ANSWERED)


def headlines(feeds: DataFrame, limit: int = text.MAX_HEADLINES) -> DataFrame:
    """Titles of the newest document per asset of a feed table (asset, feed_seq, doc)."""
    newest = Window.partitionBy("asset").orderBy(F.col("feed_seq").desc())
    latest = feeds.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1)
    return latest.select("asset", text.feed_titles(F.col("doc"), limit).alias("news_headlines"))


def _pending_columns() -> list[Column]:
    empty = {"key_factors": F.array(), "news_headlines": F.array()}
    columns = [
        F.coalesce("candle_interval", F.lit("M1")).alias(n) if n == "candle_interval" else F.col(n) for n in _DETECTED
    ]
    return columns + [
        empty.get(n, F.lit(None)).cast(schemas.EXPLANATION[n].dataType).alias(n) for n in _ANSWERED
    ]


def pending(anomalies: DataFrame) -> DataFrame:
    """Anomalies as rows of the explanation table, not yet explained."""
    return anomalies.select(*_pending_columns())


def with_prompts(anomalies: DataFrame, news: DataFrame) -> DataFrame:
    """Add ``news_headlines`` of the base asset, none where there are none, and ``prompt``."""
    joined = anomalies.withColumn("asset", base_asset(F.col("symbol"))).join(news, "asset", "left").drop("asset")
    titled = joined.withColumn(
        "news_headlines", F.coalesce("news_headlines", F.array().cast("array<string>"))
    )
    return titled.withColumn(
        "prompt",
        text.build_prompt(
            F.col("symbol"), F.coalesce("candle_interval", F.lit("M1")), F.col("detected_at"),
            F.col("anomaly_type"), F.col("severity"), F.col("current_value"), F.col("baseline_value"),
            F.col("news_headlines"),
        ),
    )


def _external_answers(prompted: DataFrame, complete: Complete) -> DataFrame:
    """Answers of ``complete``, called once per Arrow batch. If that raises, every prompt of the batch is
    asked for by itself, and only those that raise again are marked."""
    answers = "text string, prompt_tokens int, completion_tokens int, error_kind string"
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompted.schema.fields)

    def ask(prompts: pd.Series) -> pd.DataFrame:
        try:
            return complete(prompts).reset_index(drop=True)
        except Exception as error:  # what fails stays pending, the job goes on
            if len(prompts) == 1:
                return pd.DataFrame({"error_kind": [type(error).__name__]})
            return pd.concat([ask(prompts.iloc[[i]]) for i in range(len(prompts))], ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = ask(rows["prompt"]) if len(rows) else pd.DataFrame()
            for name, kind in (("text", object), ("prompt_tokens", "Int32"), ("completion_tokens", "Int32"),
                               ("error_kind", object)):
                column = out[name] if name in out else pd.Series([None] * len(rows))
                rows[name] = column.astype(kind).to_numpy() if kind is object else column.astype(kind).array
            yield rows

    return prompted.mapInPandas(run, f"{ddl}, {answers}")


def answers(anomalies: DataFrame, news: DataFrame, complete: Complete) -> DataFrame:
    """One answer of ``complete`` per anomaly. Each action on the result asks again: write it once."""
    return _external_answers(with_prompts(anomalies, news), complete)


def saves_of(answered: DataFrame, model: str, at: Column | None = None) -> DataFrame:
    """The log of saves: every anomaly pending (seq 0), then explained if it was answered (seq 1).

    Both saves of an anomaly come out of one row, so the answers are computed once.
    """
    parsed = answered.select("*", F.explode(F.array(text.parse_answer(F.col("text")))).alias("answer"))
    filled = {
        "explanation": F.col("answer.explanation"),
        "key_factors": F.col("answer.key_factors"),
        "news_headlines": F.col("news_headlines"),
        "model_used": F.lit(model),
        "explained_at": F.current_timestamp() if at is None else at,
        "prompt_tokens": F.col("prompt_tokens"),
        "completion_tokens": F.col("completion_tokens"),
    }
    pending_columns = _pending_columns()
    explained = pending_columns[: len(_DETECTED)] + [
        filled[n].cast(schemas.EXPLANATION[n].dataType).alias(n) for n in _ANSWERED
    ]
    saves = F.array_compact(F.array(
        F.struct(*pending_columns, F.lit(0).alias("seq")),
        F.when(F.col("error_kind").isNull(), F.struct(*explained, F.lit(1).alias("seq"))),
    ))
    return parsed.select(F.inline(saves))


def explain_anomalies(
    anomalies: DataFrame,
    news: DataFrame,
    complete: Complete,
    model: str,
    at: Column | None = None,
) -> DataFrame:
    """Ask for an explanation of every anomaly and return the log of saves, to be written once."""
    return saves_of(answers(anomalies, news, complete), model, at)


def upsert_explanations(saves: DataFrame, order: str = "seq") -> DataFrame:
    """Fold a log of saves per anomaly: detection columns of the first, answer columns of the last.

    The last save wins even with nulls, so a pending row sent again erases an explanation.
    """
    first = [n for n in _DETECTED if n != "anomaly_id"]
    return (
        saves.groupBy("anomaly_id")
        .agg(
            F.min_by(F.struct(*first), order).alias("first"),
            F.max_by(F.struct(*_ANSWERED), order).alias("last"),
        )
        .select("anomaly_id", "first.*", "last.*")
    )


#: Folders of the store of explanations.
BUCKETS = 64


def save_explanations(saves: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Upsert saves (rows of the explanation table with their ``seq``) into the store at ``path``.

    The store has a folder for each bucket of ids; a batch rewrites the buckets of its own ids only. What is stored
    counts as saved before: a known anomaly keeps its detection columns, and the batch's last save gives the rest, nulls too.
    """
    schema = T.StructType([*schemas.EXPLANATION.fields, T.StructField("bucket", T.IntegerType())])

    def fold(stored: DataFrame, updates: DataFrame) -> DataFrame:
        both = stored.drop("bucket").withColumn("seq", F.lit(None).cast("int")).unionByName(updates.drop("bucket"))
        return upsert_explanations(both.withColumn("seq", F.coalesce("seq", F.lit(-1)))).withColumn("bucket", keyed.bucket("anomaly_id", buckets))

    named = saves.withColumn("bucket", keyed.bucket("anomaly_id", buckets))
    keyed.merge_partitions(named, path, ["bucket"], fold, schema)


def read_explanations(spark: SparkSession, path: str) -> DataFrame:
    return keyed.read(spark, path, T.StructType([*schemas.EXPLANATION.fields, T.StructField("bucket", T.IntegerType())])).drop("bucket")

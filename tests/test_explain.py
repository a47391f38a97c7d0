import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tidemark import schemas
from tidemark.functions import text
from tidemark.operators import explain, metrics


@pytest.fixture
def anomalies(spark):
    rows = [
        ("a1", "BTC-USD", at(1700000000000), "PRICE_SPIKE", 0.0123456, 101.25, 100.0, at(1699999980000), "M1"),
        ("a2", "ETH-USD", at(1700000060000), "VOLUME_SPIKE", 4.125, 1000.0, 99.5, at(1700000000000), "M1"),
        ("a3", "SOL-USD", at(1700000060000), "VOLATILITY_SPIKE", 3.5, 1.9, 0.25, at(1700000000000), None),
    ]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ANOMALY.fields)
    return spark.createDataFrame(rows, ddl)


@pytest.fixture
def news(spark):
    return spark.createDataFrame([("BTC", ["first", "second"])], "asset string, news_headlines array<string>")


def test_prompts(anomalies, news):
    got = {r.anomaly_id: r.prompt for r in explain.with_prompts(anomalies, news).collect()}
    assert got["a1"] == (
        "Anomalia detectada em BTC-USD (M1) as 2023-11-14 22:13:20 UTC:\n"
        "Tipo: PRICE_SPIKE — variacao de preco de 1.23% (close=101.2500, anterior=100.0000)\n\n"
        "Noticias recentes relacionadas:\n  1. first\n  2. second\n\n"
        "Explique esta anomalia conforme as instrucoes."
    )
    assert f"z-score={4.125:.2f} (volume={1000.0:.2f}, media={99.5:.2f})\n\nExplique" in got["a2"]
    assert "SOL-USD (M1)" in got["a3"] and "(range=1.9000, media=0.2500)" in got["a3"]


def test_fixed_point_text_rounds_the_exact_value(spark):
    values = [0.125, 2.675, 1.005, 12.345, 0.5, 1234567.891, -0.004, 99.995, 8.5e-5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(text.fixed(F.col("v"), 2)).collect()] == [f"{v:.2f}" for v in values]


def parse(spark, answer):
    row = spark.createDataFrame([(answer,)], "t string").select(text.parse_answer(F.col("t")).alias("a")).first().a
    return row.explanation, row.key_factors


def test_answers_are_parsed(spark):
    body = '{"explanation": "because", "key_factors": ["a", "b"]}'
    assert parse(spark, body) == ("because", ["a", "b"])
    assert parse(spark, f"```json\n{body}\n```") == ("because", ["a", "b"])
    assert parse(spark, "  plain text \n") == ("plain text", [])
    assert parse(spark, "{}") == ("", [])
    assert parse(spark, '{"explanation": "x", "key_factors": [1]}') == ("x", ["1"])


@pytest.mark.parametrize("answer", [
    "4451718024887799 27.65.93.188 a text", '{"explanation": "x"} and more', "1, 2", "[1] 2", "1],[2", '1}, {"a":2', '1, "b": 2', "true story",
    '{}, {}', '{}], [{}', '{}}, {"a":{}', '{}, "b": 2', '{} {}', "12", "null", "[1, 2]",
])
def test_an_answer_that_is_not_one_object_is_plain_text(spark, answer):
    assert parse(spark, answer) == (answer, [])


@pytest.mark.parametrize("answer", [" {} ", '{"other": [1, {"b": 2}]}'])
def test_an_object_without_an_explanation_has_none(spark, answer):
    assert parse(spark, answer) == ("", [])


def test_headlines(spark):
    item = "<item><title>{}</title></item>"
    new = "<rss><channel>" + "".join(item.format(f" t{n} &amp; ") for n in range(8)) + "</channel></rss>"
    rows = [("BTC", 1, "<rss><channel><item><title>old</title></item></channel></rss>"), ("BTC", 2, new),
            ("ETH", 1, "<rss><broken"), ("SOL", 1, "<rss><channel><title>no items</title></channel></rss>"),
            ("XRP", 1, "<rss><channel>" + item.format("one") + item.format("  ") + "</channel></rss>")]
    feeds = spark.createDataFrame(rows, "asset string, feed_seq int, doc string")
    got = {r.asset: r.news_headlines for r in explain.headlines(feeds).collect()}
    assert got == {"BTC": [f"t{n} &" for n in range(5)], "ETH": [], "SOL": [], "XRP": ["one"]}


def test_upsert_replaces_only_the_answer(spark, anomalies, news):
    def complete(prompts: pd.Series) -> pd.DataFrame:
        kinds = prompts.str.extract(r"Tipo: (\w+)")[0]
        return pd.DataFrame({"text": [f'{{"explanation": "x", "key_factors": ["{k}"]}}' for k in kinds]})

    saves = explain.explain_anomalies(anomalies, news, complete, "m", at=F.lit(at(0)))
    assert saves.count() == 6
    changed = saves.filter("anomaly_id = 'a1' AND seq = 1").withColumns(
        {"seq": F.lit(2), "severity": F.lit(9.0), "explanation": F.lit("newer")})
    table = {r.anomaly_id: r for r in explain.upsert_explanations(saves.unionByName(changed)).collect()}
    assert len(table) == 3
    assert (table["a1"].explanation, table["a1"].severity) == ("newer", 0.0123456)
    assert table["a1"].news_headlines == ["first", "second"] and table["a2"].news_headlines == []
    assert table["a2"].key_factors == ["VOLUME_SPIKE"]
    assert table["a3"].candle_interval == "M1"
    # A pending row sent again erases the explanation.
    again = saves.unionByName(saves.filter("seq = 0").withColumn("seq", F.lit(5)))
    assert all(r.explanation is None and r.key_factors == [] for r in explain.upsert_explanations(again).collect())


def test_external_answers_and_failures(anomalies, news):
    def complete(prompts: pd.Series) -> pd.DataFrame:
        failed = prompts.str.contains("VOLUME_SPIKE")
        return pd.DataFrame({
            "text": ['{"explanation": "e", "key_factors": []}' if not f else None for f in failed],
            "prompt_tokens": 7, "completion_tokens": 3,
            "error_kind": ["api_error" if f else None for f in failed],
        })

    saves = explain.explain_anomalies(anomalies.coalesce(1), news, complete, "some-model")
    table = {r.anomaly_id: r for r in explain.upsert_explanations(saves).collect()}
    assert (table["a1"].explanation, table["a1"].model_used, table["a1"].prompt_tokens) == ("e", "some-model", 7)
    assert table["a2"].explanation is None and table["a2"].explained_at is None
    counts = {r.symbol: r for r in metrics.explanation_accounting(explain.upsert_explanations(saves)).collect()}
    assert (counts["BTC-USD"].explained, counts["ETH-USD"].pending, counts["SOL-USD"].completion_tokens) == (1, 1, 3)


def test_a_failing_call_leaves_rows_pending(anomalies, news):
    def complete(prompts):
        raise TimeoutError("no answer")

    answered = explain.answers(anomalies, news, complete)
    assert {r.error_kind for r in answered.collect()} == {"TimeoutError"}
    assert metrics.explanation_errors(answered).first().errors == 3
    saves = explain.saves_of(answered, "m")
    assert {r.seq for r in saves.collect()} == {0}


def test_one_failing_prompt_leaves_the_others_answered(anomalies, news):
    def complete(prompts: pd.Series) -> pd.DataFrame:
        if prompts.str.contains("ETH-USD").any():
            raise TimeoutError("no answer")
        return pd.DataFrame({"text": ["fine"] * len(prompts)})

    answered = explain.answers(anomalies.coalesce(1), news, complete)
    assert {r.anomaly_id: (r.text, r.error_kind) for r in answered.collect()} == {
        "a1": ("fine", None), "a2": (None, "TimeoutError"), "a3": ("fine", None)}

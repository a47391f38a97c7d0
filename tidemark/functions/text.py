"""Text of anomalies: prompts for an explanation, answers, feed headlines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MAX_HEADLINES = 5
_OUTER_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
_FEED = "channel struct<item: array<struct<title: string>>>, item array<struct<title: string>>"
_ANSWER = "explanation string, key_factors array<string>"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _OUTER_SPACE, "")


def fixed(value: Column, digits: int) -> Column:
    """Decimal text with ``digits`` places, rounded from the exact value of the double."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def build_prompt(
    symbol: Column,
    interval: Column,
    detected_at: Column,
    kind: Column,
    severity: Column,
    current: Column,
    baseline: Column,
    headlines: Column,
) -> Column:
    """The request to explain one anomaly, with numbered headlines if there are any."""
    # The wording.
    description = (
        F.when(
            kind == "PRICE_SPIKE",
            F.concat(
                F.lit("variacao de preco de "), fixed(severity * 100, 2), F.lit("% (close="), fixed(current, 4),
                F.lit(", anterior="), fixed(baseline, 4), F.lit(")"),
            ),
        )
        .when(
            kind == "VOLUME_SPIKE",
            F.concat(
                F.lit("pico de volume z-score="), fixed(severity, 2), F.lit(" (volume="), fixed(current, 2),
                F.lit(", media="), fixed(baseline, 2), F.lit(")"),
            ),
        )
        .when(
            kind == "VOLATILITY_SPIKE",
            F.concat(
                F.lit("pico de volatilidade z-score="), fixed(severity, 2), F.lit(" (range="), fixed(current, 4),
                F.lit(", media="), fixed(baseline, 4), F.lit(")"),
            ),
        )
        .otherwise(F.concat(F.lit("anomalia do tipo "), kind, F.lit(", severity="), fixed(severity, 4)))
    )
    at = F.coalesce(F.date_format(detected_at, "yyyy-MM-dd HH:mm:ss 'UTC'"), F.lit("N/A"))
    numbered = F.transform(
        headlines, lambda title, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), title)
    )
    news = F.when(
        F.size(headlines) > 0,
        F.concat(F.lit("\nNoticias recentes relacionadas:\n"), F.array_join(numbered, "\n")),
    )
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Anomalia detectada em "), symbol, F.lit(" ("), interval, F.lit(") as "), at, F.lit(":")),
        F.concat(F.lit("Tipo: "), kind, F.lit(" — "), description),
        news,
        F.lit("\nExplique esta anomalia conforme as instrucoes."),
    )


def _is_object(text: Column) -> Column:
    """Whether the whole text, stripped, is one JSON object.

    The parser ends at the first whole value and does not look at what follows. As the only item of an array and as a
    member of an object, nothing can follow the value: one of the two does not close or has a second item.
    """
    items = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    item = lambda n: F.try_variant_get(items, f"$[{n}]", "variant")
    whole = text.startswith("{") & item(0).isNotNull() & item(1).isNull() & member.isNotNull()
    return F.coalesce(whole, F.lit(False))


def parse_answer(text: Column) -> Column:
    """struct<explanation, key_factors> of an answer: a JSON object, a fenced one, or else the whole text."""
    cleaned = strip(F.regexp_replace(text, "```(?:json)?", ""))
    parsed = F.from_json(cleaned, _ANSWER)
    is_json = _is_object(cleaned)
    no_factors = F.array().cast("array<string>")
    return F.struct(
        F.when(is_json, F.coalesce(parsed["explanation"], F.lit(""))).otherwise(strip(text)).alias("explanation"),
        F.when(is_json, F.coalesce(parsed["key_factors"], no_factors)).otherwise(no_factors).alias("key_factors"),
    )


def feed_titles(document: Column, limit: int = MAX_HEADLINES) -> Column:
    """The first ``limit`` item titles of an RSS document; none if it cannot be read."""
    feed = F.from_xml(document, _FEED, {"mode": "PERMISSIVE"})
    items = F.coalesce(feed["channel"]["item"], feed["item"], F.array().cast("array<struct<title:string>>"))
    titles = F.transform(items, lambda item: strip(item["title"]))
    return F.slice(F.filter(titles, lambda t: t.isNotNull() & (t != "")), 1, limit)

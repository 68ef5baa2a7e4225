"""Sentiment as native expressions: the word-list scorer and the valence-lexicon scorer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.scalar import c

#: fixed values: default word lists
POSITIVE = [
    "excellent", "amazing", "great", "wonderful", "fantastic", "perfect",
    "love", "loved", "best", "brilliant", "outstanding", "superb",
    "masterpiece", "incredible", "awesome", "beautiful", "good",
]
NEGATIVE = [
    "terrible", "awful", "bad", "worst", "horrible", "poor",
    "boring", "waste", "disappointing", "disappointed", "dull",
    "weak", "fail", "failed", "hate", "hated", "trash",
]


def tokens(text: Column | str) -> Column:
    """Lower-case tokens split at ASCII white space; punctuation stays on the token."""
    return F.filter(F.split(F.lower(c(text)), r"[ \t\n\x0B\f\r]+"), lambda x: x != "")


def word_score(text: Column | str, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> Column:
    """(positive - negative hits) / tokens * 10 within [-1, 1]; 0 for null, empty or no hit."""
    # one pass over the tokens, which are made once
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("hits"))
    step = lambda a, x: F.struct((a["n"] + 1).alias("n"), (a["hits"] + x.isin(positive).cast("int") - x.isin(negative).cast("int")).alias("hits"))
    # greatest() and least() skip nulls, so the empty case is asked for first
    done = lambda a: F.when(a["n"] > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), a["hits"].cast("double") / a["n"].cast("double") * 10))).otherwise(0.0)
    return F.coalesce(F.aggregate(tokens(text), zero, step, done), F.lit(0.0))


def word_label(score: Column | str, edge: float = 0.2) -> Column:
    return F.when(c(score) > edge, "positive").when(c(score) < -edge, "negative").otherwise("neutral")


def register_sql(spark: SparkSession) -> None:
    """sentiment_score(text) and sentiment_label(text) for SQL, as temporary SQL functions (no Python is run)."""
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    toks = r"filter(split(lower(t), '[ \\t\\n\\x0B\\f\\r]+'), x -> x <> '')"
    hits = f"(size(filter({toks}, x -> x in ({quoted(POSITIVE)}))) - size(filter({toks}, x -> x in ({quoted(NEGATIVE)}))))"
    spark.sql(f"create or replace temporary function sentiment_score(t string) returns double return case when size({toks}) > 0 then greatest(-1d, least(1d, cast({hits} as double) / cast(size({toks}) as double) * 10)) else 0d end")
    spark.sql("create or replace temporary function sentiment_label(t string) returns string return case when sentiment_score(t) > 0.2 then 'positive' when sentiment_score(t) < -0.2 then 'negative' else 'neutral' end")


def compound_score(df: DataFrame, text: str, lexicon: dict[str, float], out: str = "sentiment") -> DataFrame:
    """df with a struct (compound, positive, negative, neutral) from a token valence lexicon.

    compound is s / sqrt(s * s + 15) of the summed valences s (Hutto and Gilbert, 2014); the other fields are shares of
    valence mass, where a token without valence counts 1. No negation, booster or emoji rules. Null and blank: zeros.
    The lexicon becomes a map literal; one too large for that is better joined to exploded tokens.
    """
    table = F.create_map(*[x for k, v in lexicon.items() for x in (F.lit(k), F.lit(float(v)))])
    vals = F.transform(tokens(text), lambda x: F.coalesce(F.try_element_at(table, x), F.lit(0.0)))
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("total", "pos", "neg", "neu")])

    def step(a: Column, x: Column) -> Column:
        none = F.lit(0.0)
        return F.struct(
            (a["total"] + x).alias("total"), (a["pos"] + F.when(x > 0, x + 1).otherwise(none)).alias("pos"),
            (a["neg"] + F.when(x < 0, 1 - x).otherwise(none)).alias("neg"), (a["neu"] + F.when(x == 0, 1.0).otherwise(none)).alias("neu"),
        )

    # one pass, kept in a column of its own
    tally = "_tally"
    while tally in df.columns:
        tally += "_"
    names = df.columns
    df = df.withColumn(tally, F.aggregate(vals, zero, step))
    total, pos, neg, neu = (F.col(f"{tally}.{n}") for n in ("total", "pos", "neg", "neu"))
    mass = pos + neg + neu
    or_zero = lambda x: F.coalesce(x, F.lit(0.0))
    out_df = df.withColumn(
        out,
        F.struct(
            or_zero(total / F.sqrt(total * total + 15)).alias("compound"),
            or_zero(F.try_divide(pos, mass)).alias("positive"),
            or_zero(F.try_divide(neg, mass)).alias("negative"),
            or_zero(F.try_divide(neu, mass)).alias("neutral"),
        ),
    )
    return out_df.select(*names, out) if out not in names else out_df.drop(tally)

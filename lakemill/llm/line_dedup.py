"""Line dedup with a log-template tree of fixed depth (after Drain: He et al., 2017).

A line's leaf is its token count and its ``depth`` leading tokens, where tokens that hold a digit are variable fields.
Inside a leaf the lines' masked forms are grouped into templates:

1. The votes of a group's forms give its consensus, a token for each position in which more than half of its lines
   agree. Forms that equal it in ``similarity`` of their positions are one template; positions in which they differ
   are variable.
2. The others part at the position in which the group agrees most without agreeing fully, as it tells templates apart
   better than one with many different tokens. Each part is a group of its own, and the first step is taken again.

A part ends when it is one template or has too few lines to recur, so every template of a leaf is found however many
share it. A form counts a variable field as different from anything, as Drain does: a line of which more than half is
variable (a row of numbers) is no template, and stands for its unmasked self.

A template in ``min_docs`` or more distinct documents recurs (one of ``long_tokens`` or more tokens, a passage, in two).
Its lines are dropped everywhere but where it stands first: in the document with the smallest doc_id.

Texts become (document, line number, hashes) once; only the forms of leaves that can still merge are read as tokens.

Defined results: null and empty texts stay as they are; lines without tokens are never dropped; rows with a null
doc_id stay as they are and count as no document; rows that repeat a doc_id count as one document, while each row
loses its own lines only; documents that lose all their words are removed, since everything in them stands elsewhere;
line order is kept; other columns are passed on, whatever their names (n_chars is kept true); an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.common import free_name, sized, written

WILD = "<*>"
#: all white space but the line end
_BLANKS = " \t\x0b\f\r"


def _row(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(doc_id, text)


def _count(col: Column, what: str) -> Column:
    """How often a short string stands in col."""
    return ((F.octet_length(col) - F.octet_length(F.replace(col, F.lit(what), F.lit("")))) / len(what)).cast("int")


def masked_lines(docs: DataFrame) -> DataFrame:
    """doc_id, row, line_no, n_tokens, line (its tokens, variable fields masked), open (whether it can be like another line).

    White space and variable fields are replaced in whole texts, before they become lines.
    """
    uneven = reduce(lambda a, b: a | b, [F.contains("text", F.lit(x)) for x in ("  ", *_BLANKS[1:])])
    even = F.when(uneven, F.regexp_replace("text", f"[{_BLANKS}]+", " ")).otherwise(F.col("text"))
    d = docs.select("doc_id", _row().alias("row"), even.alias("raw"))
    # a token that holds a digit; possessive, so that nothing is read twice
    mask = F.when(F.col("raw").rlike("[0-9]"), F.regexp_replace("raw", r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", WILD))
    d = d.select("doc_id", "row", F.split("raw", "\n").alias("r"), F.split(mask, "\n").alias("m"))
    # texts without digits have one form of each line
    lines = F.when(F.col("m").isNull(), F.transform("r", lambda x: F.struct(x.alias("m"), F.lit(None).cast("string").alias("r")))).otherwise(F.arrays_zip("m", "r"))
    d = d.select("doc_id", "row", F.posexplode(lines).alias("line_no", "x"))
    d = d.select("doc_id", "row", "line_no", F.trim("x.m").alias("m"), F.trim("x.r").alias("r")).where("m <> ''")
    n = _count(F.col("m"), " ") + 1
    table_row = F.col("r").isNotNull() & (2 * _count(F.col("m"), WILD) > n)
    return d.select("doc_id", "row", "line_no", n.alias("n_tokens"), F.when(table_row, F.col("r")).otherwise(F.col("m")).alias("line"), (~table_row).alias("open"))


def _leaf(depth: int) -> Column:
    return F.xxhash64("n_tokens", F.substring_index("line", " ", depth))


def _keys(docs: DataFrame, depth: int) -> DataFrame:
    """doc_id, row, line_no, n_tokens, form, leaf (null for lines that can be like no other)."""
    return masked_lines(docs).select("doc_id", "row", "line_no", "n_tokens", F.xxhash64("line").alias("form"), F.when(F.col("open"), _leaf(depth)).alias("leaf"))


def grouped_forms(docs: DataFrame, keys: DataFrame, depth: int, similarity: float, enough: Column) -> DataFrame:
    """form, n_tokens, template: the template of each form that is like others of its leaf. Other forms are not listed."""
    # forms in which no position may differ cannot be like another
    forms = keys.where(F.col("leaf").isNotNull() & (F.floor((1 - similarity) * F.col("n_tokens") + 1e-9) > 0))
    forms = forms.groupBy("leaf", "n_tokens", "form").agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    shared = forms.groupBy("leaf", "n_tokens").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"))
    shared = written(shared.where((F.col("k") > 1) & (F.col("n") >= enough) & (F.col("a") != F.col("b"))).select("leaf"))
    lines = masked_lines(docs).where("open").withColumn("leaf", _leaf(depth)).join(sized(shared), "leaf", "left_semi")
    lines = lines.groupBy("leaf", "n_tokens", F.xxhash64("line").alias("form")).agg(F.count("*").alias("n"), F.first("line").alias("line"))
    left = written(lines.select(F.col("leaf").alias("part"), "n_tokens", "form", "n", F.split("line", " ").alias("toks")))
    found: list[DataFrame] = []
    while left.head(1):
        votes = left.select("part", "n", F.posexplode("toks").alias("pos", "tok")).groupBy("part", "pos", "tok").agg(F.sum("n").alias("v"))
        v = F.col("v").cast("double")
        at = votes.groupBy("part", "pos").agg(F.max(F.struct("v", "tok")).alias("m"), F.sum("v").alias("all"), F.sum(v * v).alias("sq"), F.count("*").alias("kinds"))
        fixed = F.struct("pos", F.when(2 * F.col("m.v") > F.col("all"), F.col("m.tok")).alias("tok"))
        parting = F.max(F.when(F.col("kinds") > 1, F.struct((F.col("sq") / F.col("all") / F.col("all")).alias("x"), (-F.col("pos")).alias("at"))))
        tree = at.groupBy("part").agg(F.array_sort(F.collect_list(fixed)).alias("top"), (-parting["at"]).alias("at"))
        # nulls, positions without a consensus, equal nothing
        like = left.join(tree, "part").withColumn("eq", F.size(F.filter(F.zip_with("toks", "top", lambda a, b: a == b["tok"]), lambda x: x)))
        like = like.withColumn("one", F.col("eq") >= similarity * F.size("toks") - 1e-9)
        like = written(like.select("part", "n_tokens", "form", "n", "toks", "one", "at"))
        found.append(like.where("one").select("form", "n_tokens", F.xxhash64("part", F.lit("one")).alias("template")))
        rest = like.where(~F.col("one") & F.col("at").isNotNull()).withColumn("part", F.xxhash64("part", "at", F.get("toks", F.col("at"))))
        several = rest.groupBy("part", "n_tokens").agg(F.count("*").alias("k"), F.sum("n").alias("lines")).where((F.col("k") > 1) & (F.col("lines") >= enough))
        left = written(rest.select("part", "n_tokens", "form", "n", "toks").join(several.select("part"), "part", "left_semi"))
    if not found:
        return keys.select("form", "n_tokens", F.col("form").alias("template")).limit(0)
    return reduce(DataFrame.unionByName, found)


def recurring_lines(docs: DataFrame, min_docs: int = 3, long_tokens: int = 50, depth: int = 3, similarity: float = 0.8) -> DataFrame:
    """doc_id, row, gone: the line numbers to drop of each row that has any, in no order."""
    base = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    enough = F.when(F.col("n_tokens") >= long_tokens, F.least(F.lit(2), F.lit(min_docs))).otherwise(min_docs)
    keys = written(_keys(base, depth))
    merged = written(grouped_forms(base, keys, depth, similarity, enough))
    lines = keys.select("doc_id", "row", "line_no", "n_tokens", "form").join(sized(merged), ["form", "n_tokens"], "left")
    lines = lines.select("doc_id", "row", "line_no", "n_tokens", F.coalesce("template", "form").alias("template"))
    firsts = lines.groupBy("template", "n_tokens", "doc_id").agg(F.min(F.struct("line_no", "row")).alias("at"))
    often = firsts.groupBy("template", "n_tokens").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "at")).alias("first")).where(F.col("n_docs") >= enough)
    often = written(often.select("template", "n_tokens", F.col("first.doc_id").alias("keep_doc"), F.col("first.at.line_no").alias("keep_line"), F.col("first.at.row").alias("keep_row")))
    first = (F.col("doc_id") == F.col("keep_doc")) & (F.col("line_no") == F.col("keep_line")) & (F.col("row") == F.col("keep_row"))
    gone = lines.join(sized(often), ["template", "n_tokens"]).where(~first)
    # repeated rows give a line number twice
    return gone.groupBy("doc_id", "row").agg(F.collect_set("line_no").alias("gone"))


def drop_recurring(docs: DataFrame, **settings) -> DataFrame:
    """docs (doc_id, text and any others) without recurring lines, and without the rows that have no words left."""
    names = docs.columns
    doc, row, drop, lines = (free_name(names, n) for n in ("_doc", "_row", "_gone", "_lines"))
    gone = recurring_lines(docs, **settings).select(F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("gone").alias(drop))
    own = free_name(names, "_own")
    # texts travel as lines, so that they are parted once
    parted = docs.select(*[n for n in names if n != "text"], F.split("text", "\n").alias(lines), _row().alias(own))
    out = parted.join(gone, (F.col("doc_id") == F.col(doc)) & (F.col(own) == F.col(row)), "left")
    changed = F.col(drop).isNotNull()
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    out = out.where(~changed | F.exists(kept, lambda i: F.get(lines, i).rlike(r"\S")))
    left = F.when(changed, F.transform(kept, lambda i: F.get(lines, i))).otherwise(F.col(lines))
    out = out.withColumn("text", F.when(F.col(lines).isNotNull(), F.concat_ws("\n", left)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*names)

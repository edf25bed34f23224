"""Line deduplication by a log-template tree of fixed depth, with DataFrame functions only.

A line's tokens lead to a leaf: their number, then the first DEPTH tokens, of which those with
a digit count as variable. Within a leaf a token that few lines have at its place is a variable
field, too. A line with its variable fields masked is a template; templates that recur in
MIN_TEXTS different texts are boilerplate, and their lines are dropped. A line of which most
tokens are variable is merged with no other and counts as it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from swipeline.session import cut_lineage

DEPTH = 3
MIN_TEXTS = 5
#: Share of a template's tokens that are no variable fields, at least, for different lines to
#: be merged in it.
SIMILARITY = 0.5
VARIABLE = "<*>"

KEY = ["id", "text_key"]
#: Two hashes stand for a leaf, a line or a template wherever its text is not needed.
LEAF, LINE, GROUP = ["leaf_a", "leaf_b"], ["line_a", "line_b"], ["group_a", "group_b"]


def masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), VARIABLE).otherwise(token)


def hashed(names: list[str], *values: Column) -> list[Column]:
    """128 bits in two columns."""
    return [F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in enumerate(names)]


def text_lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, text_key, number, line, hashes of line and leaf) of every line with a token. Tokens
    stand between single blanks, without those at the line's ends."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.xxhash64(text).alias("text_key"),
        F.posexplode(F.split(text, "\n")).alias("number", "line"),
    )
    rows = rows.select(*KEY, "number", F.trim("line").alias("line")).where("line <> ''")
    # counted and cut as text: no list of tokens is made for a line
    size = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    head = F.regexp_replace(F.substring_index("line", " ", DEPTH), "[^ ]*[0-9][^ ]*", VARIABLE)
    return rows.select(*KEY, "number", "line", *hashed(LINE, F.col("line")), *hashed(LEAF, size, head))


def recurring(rows: DataFrame, *by: str) -> DataFrame:
    """The groups that occur in MIN_TEXTS different texts, counted before the last shuffle."""
    texts = rows.select(*by, "text_key").distinct()
    return texts.groupBy(*by).agg(F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= MIN_TEXTS)


def line_templates(lines: DataFrame) -> DataFrame:
    """(line, group, template) of the lines of leaves that hold several, without those that cannot
    recur; the template of a verbatim line is the line itself.

    A line's text is kept once. Its tokens travel with the hashes of line and leaf, so the work
    grows with the tokens, however long a line is. The leading tokens are the same in all
    lines of a leaf, and constant as the leaf recurs; only those behind are counted.
    """
    different = cut_lineage(
        lines.groupBy(*LINE).agg(
            F.first("line").alias("line"), *[F.first(c).alias(c) for c in LEAF], F.count(F.lit(1)).alias("n")
        )
    )
    tokens = different.select(*LINE, *LEAF, "n", F.posexplode(F.split("line", " ")).alias("place", "token"))
    tokens = tokens.where(F.col("place") >= DEPTH).where(~F.col("token").rlike("[0-9]"))
    constant = (
        tokens.groupBy(*LEAF, "place", "token").agg(F.sum("n").alias("times"))
        .where(F.col("times") >= MIN_TEXTS).drop("times")
    )
    fixed = tokens.join(constant, [*LEAF, "place", "token"]).groupBy(*LINE).agg(
        F.collect_list(F.struct("place", "token")).alias("fixed")
    )
    known = different.join(fixed, LINE, "left").withColumns({
        "size": F.size(F.split("line", " ")),
        "head": F.transform(F.slice(F.split("line", " "), 1, DEPTH), lambda t, i: F.struct(i.alias("place"), masked(t).alias("token"))),
        "fixed": F.coalesce("fixed", F.array().cast("array<struct<place:int,token:string>>")),
    })
    places = F.when(
        F.col("size") > DEPTH, F.sequence(F.lit(DEPTH), F.col("size") - 1)
    ).otherwise(F.array().cast("array<int>"))
    rest = F.transform(
        F.array_except(places, F.transform("fixed", lambda f: f["place"])),
        lambda i: F.struct(i.alias("place"), F.lit(VARIABLE).alias("token")),
    )
    fields = F.array_sort(F.concat("head", "fixed", rest))
    n_fixed = F.size("fixed") + F.size(F.filter("head", lambda f: f["token"] != VARIABLE))
    verbatim = n_fixed / F.col("size") < SIMILARITY
    template = F.when(verbatim, F.col("line")).otherwise(F.array_join(F.transform(fields, lambda f: f["token"]), " "))
    # a line that occurs fewer times is in fewer texts
    found = known.where(~verbatim | (F.col("n") >= MIN_TEXTS))
    found = found.select(*LINE, *LEAF, template.alias("template"), verbatim.alias("verbatim"))
    return found.select(*LINE, "template", *hashed(GROUP, *map(F.col, LEAF), F.col("template"), F.col("verbatim")))


def boilerplate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_key, number, template, n_texts): the lines, numbered from 0 in their text,
    whose template recurs."""
    lines = text_lines(docs, id_column, text_column)
    # a table first, so that its size is known: with few leaves the lines stay where they are
    leaves = cut_lineage(recurring(lines, *LEAF))
    candidates = cut_lineage(lines.join(leaves, LEAF))
    several = (F.min(LINE[0]) != F.max(LINE[0])) | (F.min(LINE[1]) != F.max(LINE[1]))
    mixed = cut_lineage(candidates.groupBy(*LEAF).agg(several.alias("mixed")).where("mixed").select(*LEAF))
    # the one line of a leaf recurs as the leaf does
    fields = F.transform(F.split("line", " "), masked)
    constant = F.size(F.filter(fields, lambda t: t != VARIABLE)) / F.size(fields)
    template = F.when(constant < SIMILARITY, F.col("line")).otherwise(F.array_join(fields, " "))
    single = candidates.join(mixed, LEAF, "left_anti").select(*KEY, "number", template.alias("template"), "n_texts")
    among = candidates.join(mixed, LEAF, "left_semi")
    placed = cut_lineage(
        among.select(*KEY, "number", *LINE).join(line_templates(among), LINE).select(
            *KEY, "number", *GROUP, "template"
        )
    )
    shared = placed.join(recurring(placed, *GROUP), GROUP)
    return single.unionByName(shared.select(*KEY, "number", "template", "n_texts"))


def drop_boilerplate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of docs with n_lines, n_dropped, dropped (numbers of the dropped lines) and
    kept, its other lines; the row itself is the struct `row`.

    A null text has no lines and keeps none (kept is null), an empty one has one empty line.
    Lines without tokens are never dropped. Copies of a text count as one text; repeated rows
    lose the same lines, and lines that occur equally often are treated alike: there are no ties.
    A very long line is handled token by token, in time that grows with its length. An empty
    table gives no rows; other columns are carried along under any names.
    """
    found = boilerplate(docs, id_column, text_column).dropDuplicates([*KEY, "number"])
    dropped = found.groupBy(*KEY).agg(F.sort_array(F.collect_list("number")).alias("dropped"))
    text = F.col(f"`{text_column}`")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_column}`").alias("__id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__key"),
    )
    same = rows["__id"].eqNullSafe(dropped["id"]) & (rows["__key"] == dropped["text_key"])
    # the text travels once, in its row, and is cut into lines behind the join
    joined = rows.join(dropped, same, "left").withColumns({
        "dropped": F.coalesce("dropped", F.array().cast("array<int>")),
        "lines": F.split(F.col(f"row.`{text_column}`"), "\n"),
    })
    joined = joined.withColumn("n_lines", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(left, lambda k: F.col("lines")[k]), "\n")
    whole = F.array_join("lines", "\n")
    return joined.select(
        "row", F.col("n_lines").cast("bigint"), F.size("dropped").cast("bigint").alias("n_dropped"), "dropped",
        F.when(F.size("dropped") > 0, kept).otherwise(whole).alias("kept"),
    )

"""Personal data, and the terms that give it away, with DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Their values are the
protected entities. A term that shares lines with an entity discloses it as far as it lowers
the entity's information content: PMI(term; entity) / IC(entity), estimated from how many
lines of the corpus hold the term, the entity, and both. What few
different lines support is estimated by a lower bound instead. Terms over a threshold of disclosure
are generalised in the entity's lines, and over a second one removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from swipeline.llm.tables import ascii_lower
from swipeline.session import cut_lineage

KINDS = ["email", "ip", "card", "phone"]
TERM = "term"

# What the kinds look like. Quantifiers are possessive where giving back could
# not help, which keeps Java's matcher from recursing on long runs; a look behind keeps it from
# trying each place of a run anew.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to occur in it at all.
HINTS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Lines with different texts that hold an entity, and entity and term together, from which the
#: plain estimate counts; below, a lower bound does.
SUPPORT = 3
#: Standard deviations of that bound: two-sided 95 %.
DEVIATIONS = 1.96
#: Share of an entity's information content from which a term is generalised, and removed.
GENERALISE, REMOVE = 0.75, 0.95
#: Elements that are put behind each other at a time when places are summed up.
BLOCK = 256

PLACES = "array<struct<start: bigint, behind: bigint, value: string>>"


def luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a match counts: parts of an address, digits of a number."""
    if kind == "ip":
        return match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.translate(match, "+ ().-", "")).between(8, 15)
    return F.lit(True)


def put_behind(sized: Column, blocks: Column) -> Column:
    """Places of elements (gap before, size, keep) that follow each other: the kept ones as
    spans, with their values. `blocks` numbers the runs of BLOCK elements of `sized`.

    Spans are gathered by block, so that a long list is not copied for each of them.
    """

    def one(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        here = F.struct(start.alias("start"), (start + x["size"]).alias("behind"), x["value"].alias("value"))
        return F.struct(
            (start + x["size"]).alias("at"),
            F.when(x["keep"], F.concat(state["out"], F.array(here))).otherwise(state["out"]).alias("out"),
        )

    def block(state: Column, number: Column) -> Column:
        start = F.struct(state["at"].alias("at"), F.array().cast(PLACES).alias("out"))
        own = F.aggregate(F.slice(sized, number * BLOCK + 1, F.lit(BLOCK)), start, one)
        return F.struct(own["at"].alias("at"), F.concat(state["out"], own["out"]).alias("out"))

    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(PLACES).alias("out"))
    return F.aggregate(blocks, empty, block)["out"]


def with_places(rows: DataFrame, text: str, pattern: str, check, to: str, hint: str | None = None) -> DataFrame:
    """Add a column of (start, behind, value): the matches of a pattern, leftmost first and
    not overlapping, in code points, of which only those that pass the check are listed.

    The pieces between the matches and the matches themselves give the places.
    """
    pieces, found, sized = f"{to}_pieces", f"{to}_found", f"{to}_sized"
    source = F.col(text)
    possible = source.rlike(hint) if hint else F.lit(True)
    out = rows.withColumns(
        {
            pieces: F.when(possible, F.split(source, pattern, -1)),
            found: F.when(possible, F.regexp_extract_all(source, F.lit(pattern), F.lit(0))),
        }
    )
    def element(gap: Column, match: Column) -> Column:
        return F.struct(
            F.length(gap).cast("bigint").alias("gap"), F.length(match).cast("bigint").alias("size"),
            F.coalesce(check(match), F.lit(False)).alias("keep"), match.alias("value"),
        )

    elements = F.filter(F.zip_with(pieces, found, element), lambda x: x["value"].isNotNull())
    out = out.withColumn(sized, F.when(F.size(found) > 0, elements))
    numbers = F.sequence(F.lit(0), ((F.size(sized) - 1) / BLOCK).cast("int"))
    places = F.when(F.size(sized) > 0, put_behind(F.col(sized), numbers))
    return out.withColumn(to, F.coalesce(places, F.array().cast(PLACES))).drop(pieces, found, sized)


def with_base_spans(rows: DataFrame, text: str) -> DataFrame:
    """Add a column of places for each kind."""
    for kind in KINDS:
        rows = with_places(
            rows, text, PATTERNS[kind], lambda m, k=kind: valid(k, m), kind, HINTS[kind]
        )
    return rows


def base_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(row, id, text_key, places by kind, lines): lines are the text's lines that hold an
    entity, with their places; no match crosses a line."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    rows = with_base_spans(rows, "text")
    some = sum((F.size(k) for k in KINDS), F.lit(0)) > 0
    rows = rows.withColumn("marked", F.when(some, F.col("text")).otherwise(F.lit("")))
    any_kind = "|".join(HINTS[k] for k in KINDS)
    rows = with_places(rows, "marked", r"[^\n]+", lambda m: m.rlike(any_kind), "lines")
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "id", F.xxhash64("text").alias("text_key"), *KINDS, "lines"
    )


def entity_lines(base: DataFrame) -> DataFrame:
    """(row, start, line, entities, words): a line with entities; words are its terms outside of
    them, with their places in the line."""
    lines = base.where(F.size("lines") > 0).select("row", F.explode("lines").alias("l"))
    lines = lines.select("row", F.col("l.start").alias("start"), F.col("l.value").alias("line"))
    lines = with_base_spans(lines, "line")
    spans = F.concat(*KINDS)
    lines = lines.withColumn("spans", spans).where(F.size("spans") > 0)
    lines = lines.withColumn("low", ascii_lower(F.col("line")))  # of the same length
    lines = with_places(lines, "low", WORD, lambda m: F.lit(True), "every")

    def outside(w: Column) -> Column:
        return ~F.exists("spans", lambda s: (s["start"] < w["behind"]) & (w["start"] < s["behind"]))

    entities = F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"])))
    words = F.transform(
        F.filter("every", outside),
        lambda w: F.struct(w["start"].alias("start"), w["behind"].alias("behind"), w["value"].alias("term")),
    )
    return lines.select("row", "start", "line", entities.alias("entities"), words.alias("words"))


def line_counts(docs: DataFrame, text_column: str) -> tuple[DataFrame, int]:
    """(term, n): lines of the corpus that hold each term; and the number of all lines that
    have a term."""
    text = ascii_lower(F.col(f"`{text_column}`"))
    lines = docs.select(F.explode(F.split(text, "\n")).alias("line"))
    terms = lines.select(F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit(WORD), F.lit(0)))).alias("term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    total = lines.where(F.col("line").rlike(WORD)).count()
    return counts, total


def least_share() -> Column:
    """Wilson's lower bound of the share of a term's lines that hold the entity; copies of a line
    are one trial."""
    p = F.least(F.lit(1.0), F.col("n_both") / F.col("n"))
    trials = F.col("both_lines") / p
    square = F.lit(DEVIATIONS**2)
    spread = F.sqrt(p * (1 - p) / trials + square / (4 * trials * trials))
    return (p + square / (2 * trials) - F.lit(DEVIATIONS) * spread) / (1 + square / trials)


def disclosing(lines: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(entity, term, share): the terms that disclose entities. An entity of all lines has no
    information content and is disclosed by none."""
    line = F.xxhash64("line").alias("line")
    seen = lines.select(line, F.explode("entities").alias("entity"), "words")
    entities = seen.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity"), F.countDistinct("line").alias("entity_lines")
    )
    terms = F.array_distinct(F.transform("words", lambda w: w["term"]))
    pairs = (
        seen.select("line", "entity", F.explode(terms).alias("term"))
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_both"), F.countDistinct("line").alias("both_lines"))
    )
    all_lines = F.lit(float(total))
    pmi = F.log2(F.col("n_both") * all_lines / (F.col("n") * F.col("n_entity")))
    plain = F.try_divide(pmi, F.log2(all_lines / F.col("n_entity")))
    low = F.log2(least_share() * all_lines / F.col("entity_lines"))
    bounded = F.try_divide(low, F.log2(all_lines / F.col("entity_lines")))
    supported = F.least("entity_lines", "both_lines") >= SUPPORT
    return (
        pairs.join(entities, "entity")
        .join(counts, "term")
        .select("entity", "term", F.when(supported, plain).otherwise(bounded).alias("share"))
        .where(F.col("share") >= GENERALISE)
    )


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of docs: id, text_key (hash of the text), the places of each base kind,
    and terms, the places of disclosing terms with `removed` telling removal from
    generalisation. Places are in code points, the end exclusive.

    A null text is empty. Of overlapping matches of one kind the leftmost counts; different
    kinds may overlap. Terms lie outside of base spans, which always stay. Repeated rows
    each have their spans; copies of a line are one line for the support and the bound. An empty table gives
    no rows; other columns of docs are not read.
    """
    base = cut_lineage(base_rows(docs, id_column, text_column))
    lines = cut_lineage(entity_lines(base))
    flagged = disclosing(lines, *line_counts(docs, text_column))
    occurrences = lines.select("row", "start", F.explode("entities").alias("entity"), "words").select(
        "row", "start", "entity", F.explode("words").alias("word")
    )
    terms = (
        occurrences.select(
            "row", "start", "entity", "word.term",
            F.col("word.start").alias("low"), F.col("word.behind").alias("high"),
        )
        .join(flagged, ["entity", "term"])
        .groupBy("row", (F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high")).alias("behind"))
        .agg((F.max("share") >= REMOVE).alias("removed"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "behind", "removed"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start: bigint, behind: bigint, removed: boolean>>")
    joined = base.drop("lines").join(terms, "row", "left")
    return joined.withColumn("terms", F.coalesce("terms", none)).drop("row")


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with their texts sanitised: an entity becomes the name of its kind in brackets, a
    generalised term `[term]`, and a removed term nothing. Of overlapping spans the leftmost is
    replaced and those that begin inside it fall with it."""

    def marked(column: str, by) -> Column:
        return F.transform(
            column, lambda s: F.struct(s["start"].alias("start"), s["behind"].alias("behind"), by(s).alias("by"))
        )

    marks = [marked(k, lambda s, name=f"[{k}]": F.lit(name)) for k in KINDS]
    marks.append(marked("terms", lambda s: F.when(s["removed"], F.lit("")).otherwise(F.lit(f"[{TERM}]"))))
    found = find(docs, id_column, text_column).select("id", "text_key", F.sort_array(F.concat(*marks)).alias("marks"))
    found = found.where(F.size("marks") > 0).dropDuplicates(["id", "text_key"])
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    keyed = docs.withColumn("__key", F.xxhash64(text)).join(
        found.select(F.col("id").alias("__id"), F.col("text_key").alias("__text_key"), F.col("marks").alias("__marks")),
        F.col(f"`{id_column}`").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__text_key")),
        "left",
    )

    def step(state: Column, m: Column) -> Column:
        between = F.substring(text, state["at"].cast("int") + 1, (m["start"] - state["at"]).cast("int"))
        changed = F.struct(F.concat(state["out"], between, m["by"]).alias("out"), m["behind"].alias("at"))
        return F.when(m["start"] >= state["at"], changed).otherwise(
            F.struct(state["out"].alias("out"), F.greatest(state["at"], m["behind"]).alias("at"))
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    clean = F.aggregate(
        "__marks", start, step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"].cast("int") + 1, F.length(text))),
    )
    cleaned = F.when(F.col("__marks").isNull(), F.col(f"`{text_column}`")).otherwise(clean)
    return keyed.select(*[cleaned.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns])

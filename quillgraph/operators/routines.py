"""Routine sources: labels, calls and line features as column expressions, and their checks and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .edges import edges
from .upsert import repeat_groups

#: A label line, a returned value, and the beginnings of entry-point names.
LABEL = r"^([A-Z][A-Z0-9]*)\s*(\([^)]*\))?\s*(;.*)?$"
RETURNS = r"Q\s+\$\$|QUIT\s+\$\$"
ENTRY_POINTS = ("EN", "EP", "START", "INIT")
#: What a line is searched for.
PATTERNS = {
    "globals": r"\^[A-Z0-9$%]+",
    "subscripted_globals": r"\^[A-Z0-9$%]+\([^)]*\)",
    "functions": r"\$\$[A-Z0-9]+",
    "intrinsics": r"\$[A-Z0-9]+",
    "quoted": r'"[^"]*"',
    "assignments": r"[A-Z0-9$%]+=",
    "numbers": r"\b\d+\.?\d*\b",
    "words": r"(?i)\b[A-Z0-9]+\b",
    "symbols": r"[^\w\s]",
}
#: What the wider search of a line is for, besides.
WIDER = {
    "parenthesized": r"\([^)]*\)",
    "bracketed": r"\[[^\]]*\]",
    "dollars": r"\$\$?[A-Z0-9$%]*",
    "commands": r"\b[A-Z]\b",
    "gotos": r"\b[A-Z0-9]+\^[A-Z0-9]+",
    "dates": r"\b\d{6,8}\b",
    "comments": r";.*$",
}
#: Classes of characters.
CLASSES = {"alpha": r"[^\p{L}]", "digit": r"[^0-9]", "upper": r"[^\p{Lu}]", "lower": r"[^\p{Ll}]", "punct": r"[^!-/:-@\[-`{-~]"}
#: A call that names label and routine, and the second line of a source: version, package, patches.
CALL = r"([A-Z%][A-Z0-9]*)\^([A-Z%][A-Z0-9]*)"
HEADER = r"^\s*;;([^;]*);[^;]*(?:;(?:\*\*([^*;]*)\*\*)?.*)?$"
#: Weights of the criteria by which schemas are scored.
WEIGHTS = {"technical_score": 0.4, "stakeholder_fit": 0.3, "implementability": 0.2, "maintainability": 0.1}
#: Confidence of a call by how it was found: named in full, by label alone, guessed.
CONFIDENCE = {"exact": 1.0, "label": 0.7}


def read_routines(spark: SparkSession, path: str) -> DataFrame:
    """routine, line_no, line of every file in a directory; the routine is the file's name without its ending."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("routine"), "value")
    return lines_of(text.withColumnRenamed("value", "text"))


def lines_of(texts: DataFrame) -> DataFrame:
    """routine, text to routine, line_no (from 1), line."""
    return texts.select("routine", F.posexplode(F.split("text", "\r?\n")).alias("i", "line")).select("routine", (F.col("i") + 1).alias("line_no"), "line")


def _is_label(lines: DataFrame) -> Column:
    """A line that is a label; a first line with ;; is a header."""
    return F.col("line").rlike(LABEL) & ~((F.col("line_no") == 1) & F.col("line").contains(";;"))


def within(lines: DataFrame) -> DataFrame:
    """lines with label and label_line, those of the last label at or above the line; null above a routine's first."""
    above = Window.partitionBy("routine").orderBy("line_no")
    mark = F.when(_is_label(lines), F.struct(F.regexp_extract("line", LABEL, 1).alias("label"), F.col("line_no").alias("label_line")))
    return lines.withColumn("_m", F.last(mark, ignorenulls=True).over(above)).select("routine", "line_no", "line", "_m.label", "_m.label_line")


def labels(lines: DataFrame) -> DataFrame:
    """routine, label, line_no, parameters, comment, is_entry_point, is_function: the lines that are a label. A label is a function if a line of its
    body returns a value."""
    found = F.regexp_extract("line", LABEL, 1)
    entry = F.lit(False)
    for e in ENTRY_POINTS:
        entry = entry | found.startswith(e)
    names = F.filter(F.split(F.regexp_replace(F.regexp_extract("line", LABEL, 2), "[()]", ""), r"\s*,\s*"), lambda x: x != "")
    own = within(lines)
    returns = F.max(F.col("line").rlike(RETURNS)).over(Window.partitionBy("routine", "label_line"))
    rows = own.withColumn("is_function", returns).where("line_no = label_line")
    return rows.select("routine", found.alias("label"), "line_no", names.alias("parameters"), F.regexp_replace(F.regexp_extract("line", LABEL, 3), r"^[;\s]+|[;\s]+$", "").alias("comment"), entry.alias("is_entry_point"), "is_function")


def calls(lines: DataFrame) -> DataFrame:
    """routine, label, label_line, to_label, to_routine: every call in a body that names label and routine."""
    named = F.regexp_extract_all("line", F.lit(CALL), F.lit(0))
    return within(lines).select("routine", "label", "label_line", F.explode(named).alias("c")).select("routine", "label", "label_line", F.substring_index("c", "^", 1).alias("to_label"), F.substring_index("c", "^", -1).alias("to_routine"))


def resolved(calls: DataFrame, labels: DataFrame) -> DataFrame:
    """calls with found_routine, found_label, found_line and how: the label that each call means.

    exact: label and routine are there (each such label, if a routine has it more than once). label: the label stands in one routine alone, whatever routine
    is named. guess: else the first label of the routine that is named, or of all routines with the label the first by name. A call of none of
    these is left out.
    """
    at = F.struct("routine", "line_no", "label")
    exact = labels.select(F.col("routine").alias("to_routine"), F.col("label").alias("to_label"), at.alias("exact"))
    by_label = labels.groupBy(F.col("label").alias("to_label")).agg(F.min(at).alias("first"), F.max("routine").alias("last_routine"))
    by_routine = labels.groupBy(F.col("routine").alias("to_routine")).agg(F.min(F.struct("line_no", "label")).alias("top"))
    met = calls.join(exact, ["to_routine", "to_label"], "left").join(by_label, "to_label", "left").join(by_routine, "to_routine", "left")
    alone = F.col("first.routine") == F.col("last_routine")
    top = F.when(F.col("top").isNotNull(), F.struct(F.col("to_routine").alias("routine"), F.col("top.line_no").alias("line_no"), F.col("top.label").alias("label")))
    how = F.when(F.col("exact").isNotNull(), "exact").when(alone, "label").otherwise("guess")
    told = met.withColumns({"how": how, "means": F.coalesce("exact", F.when(alone, F.col("first")), top, "first")}).where("means IS NOT NULL")
    return told.select(*calls.columns, F.col("means.routine").alias("found_routine"), F.col("means.label").alias("found_label"), F.col("means.line_no").alias("found_line"), "how")


def dependencies(calls: DataFrame, labels: DataFrame) -> DataFrame:
    """routine, depends_on, confidence, call_count: calls of other routines, by how surely they are meant. Equal calls of a routine are counted before they are looked up."""
    some = calls.where("label IS NOT NULL").groupBy("routine", "to_routine", "to_label").agg(F.count(F.lit(1)).alias("n"))
    met = resolved(some, labels).where("routine <> found_routine")
    return met.groupBy("routine", F.col("found_routine").alias("depends_on"), confidence(F.col("how")).alias("confidence")).agg(F.sum("n").alias("call_count")).orderBy(F.col("call_count").desc(), "routine", "depends_on", "confidence")


def routine_nodes(lines: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Routine nodes: the package that owns them and by which prefix, lines, and what their first two lines tell."""
    at = lambda n: F.max(F.when(F.col("line_no") == n, F.col("line")))
    told = lines.groupBy("routine").agg(F.count(F.lit(1)).alias("lines_of_code"), at(1).alias("first"), at(2).alias("second"))
    part = lambda n: F.nullif(F.regexp_extract("second", HEADER, n), F.lit(""))
    owned = owners(lines, prefixes)
    return told.join(owned, "routine", "left").select(
        F.col("routine").alias("name"),
        F.col("package").alias("package_name"),
        "prefix",
        "lines_of_code",
        part(1).alias("version"),
        F.coalesce(F.split(part(2), ","), F.array().cast("array<string>")).alias("patches"),
        F.nullif(F.regexp_replace(F.regexp_extract("first", r";(.*)$", 1), r"^[;\s]+|[;\s]+$", ""), F.lit("")).alias("description"),
    )


def label_nodes(labels: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "routine", "label", "line_no")
    return labels.select(key.alias("label_id"), F.col("label").alias("name"), F.col("routine").alias("routine_name"), F.col("line_no").alias("line_number"), "is_entry_point", "is_function", "parameters", "comment")


def contains_label(routines: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges from routine nodes to their label nodes."""
    held = labels.join(routines.select(F.col("name").alias("src")), F.col("routine_name") == F.col("src"))
    return edges("CONTAINS_LABEL", held.select("src", F.col("label_id").alias("dst"), "line_number"), line_number="line_number")


def owns_routine(routines: DataFrame) -> DataFrame:
    """Edges from packages to the routines that their prefixes name."""
    return edges("OWNS_ROUTINE", routines.where("package_name IS NOT NULL").select(F.col("package_name").alias("src"), F.col("name").alias("dst"), "prefix"), prefix="prefix")


def owners(routines: DataFrame, prefixes: DataFrame) -> DataFrame:
    """routine, package, prefix: the package with the longest prefix (prefix, name) that the routine's name begins with.

    Each name asks by its own beginnings, so this is an equi join.
    """
    asked = routines.select("routine").distinct().withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.length("routine")), lambda n: F.substring("routine", F.lit(1), n))))
    return asked.join(prefixes, "prefix").groupBy("routine").agg(F.max_by("name", F.length("prefix")).alias("package"), F.max_by("prefix", F.length("prefix")).alias("prefix"))


def orphan_routines(routines: DataFrame, owned: DataFrame) -> DataFrame:
    return routines.select("routine").distinct().join(owned, "routine", "left_anti")


def repeated_routines(routines: DataFrame) -> DataFrame:
    """routine, count of the names that stand more than once."""
    return repeat_groups(routines, ["routine"])


def found(line: Column, pattern: str) -> Column:
    """Every match in a line, in order."""
    return F.regexp_extract_all(line, F.lit((PATTERNS | WIDER)[pattern]), 0)


def features(lines: DataFrame) -> DataFrame:
    """What each line is and how much of each pattern it holds."""
    line = F.col("line")
    indent = F.length(line) - F.length(F.regexp_replace(line, r"^\s+", ""))
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    counts = [F.size(found(line, p)).alias(p) for p in PATTERNS]
    return lines.select(
        "routine",
        "line_no",
        F.length(line).alias("length"),
        indent.alias("indent"),
        (~line.rlike(r"^[ \t]") & (bare != "")).alias("is_label"),
        line.rlike(r"^[ \t]").alias("is_code"),
        bare.startswith(";").alias("is_comment"),
        F.nullif(F.regexp_extract(line, r"^\s*([A-Z]+)\s", 1), F.lit("")).alias("command"),
        *counts,
        F.array_distinct(found(line, "globals")).alias("global_names"),
    )


def wider_features(lines: DataFrame) -> DataFrame:
    """How much of each further pattern a line holds, and of each class of characters."""
    line = F.col("line")
    return lines.select("routine", "line_no", *[F.size(found(line, p)).alias(p) for p in WIDER], *[F.length(F.regexp_replace(line, p, "")).alias(n) for n, p in CLASSES.items()])


def character_counts(lines: DataFrame) -> DataFrame:
    """routine, line_no, characters: a map of each character of the line to how often it stands in it. A line stays one row and goes through no shuffle: each of its
    different characters is counted by what the line loses without it."""
    line = F.col("line")
    each = F.filter(F.array_distinct(F.split(line, "")), lambda c: c != "")
    counts = F.transform(each, lambda c: (F.length(line) - F.length(F.replace(line, c, F.lit("")))).cast("int"))
    return lines.select("routine", "line_no", F.map_from_arrays(each, counts).alias("characters"))


def roll_up(told: DataFrame) -> DataFrame:
    """features() by routine: totals, and the different commands and globals in order."""
    return told.groupBy("routine").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if("is_label").alias("labels"),
        F.count_if("is_comment").alias("comments"),
        *[F.sum(p).alias(p) for p in PATTERNS],
        F.array_join(F.array_sort(F.collect_set("command")), ",").alias("commands"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("global_names")))), ",").alias("unique_globals"),
    )


def coverage(told: DataFrame, captured: Column) -> DataFrame:
    """One row: the share of lines for which captured holds."""
    return told.agg(F.avg(captured.cast("double")).alias("coverage"))


def scores(schemas: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """schemas (schema and a column for each criterion) with score, their weighted sum; a missing criterion counts as 0."""
    total = F.lit(0.0)
    for c, w in (weights or WEIGHTS).items():
        total = total + F.coalesce(F.col(c), F.lit(0.0)) * w
    return schemas.withColumn("score", total)


def best(scored: DataFrame) -> DataFrame:
    """One row: the schema with the highest score, of equal ones the least by name."""
    return scored.agg(F.min_by(F.struct("schema", "score"), F.struct((-F.col("score")).alias("s"), "schema")).alias("b")).select("b.*")


def confidence(how: Column) -> Column:
    """1.0, 0.7 or 0.5 by how a reference was found."""
    c = F.lit(0.5)
    for name, value in CONFIDENCE.items():
        c = F.when(how == name, F.lit(value)).otherwise(c)
    return c


def stratified(df: DataFrame, strata: Column, each: int, seed: int = 1) -> DataFrame:
    """`each` rows of every stratum, those with the least hashes: a sampling operator, the same on every run."""
    key = F.xxhash64(F.lit(seed), *[F.col(c) for c in df.columns])
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_key"))
    return df.withColumn("_stratum", strata).withColumn("_key", key).withColumn("_rank", rank).where(F.col("_rank") <= each).drop("_stratum", "_key", "_rank")


# -- a sample over several strata ------------------------------------------------------------------------------------------------

#: Of how many units the sample by size is, sizes that part small, middle and large units and the share of each, units of each package, units at random.
SAMPLE, SIZES, SHARES, OF_PACKAGE, AT_RANDOM = 200, (100, 500), (0.2, 0.5, 0.3), 5, 50
#: Labels that part simple, middle and complex units, and units of each.
COMPLEXITY, OF_COMPLEXITY = (3, 10), 20


def sample_key(unit: Column, dimension: Column, seed: int = 1) -> Column:
    """What orders units in a stratum: a digest of seed, dimension and unit, the same in any engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), dimension, unit.cast("string")))


def strategic_sample(units: DataFrame, seed: int = 1, sizes: tuple[int, int] = SIZES, complexity: tuple[int, int] = COMPLEXITY) -> DataFrame:
    """units (unit, size, package, labels), each unit once, to unit, strata: those of a sample by size, package and complexity and at random, each unit
    once, with the strata that have taken it.

    A stratum takes the units with the least keys. Spark keeps no more than the highest number of any stratum in each partition before it
    shuffles, so a package that holds most units costs no more than others.
    """
    size = F.when(F.col("size") < sizes[0], "small").when(F.col("size") < sizes[1], "middle").otherwise("large")
    labels = F.when(F.col("labels") < complexity[0], "simple").when(F.col("labels") < complexity[1], "middle").otherwise("complex")
    small, middle, large = (round(SAMPLE * s) for s in SHARES)
    stratum = lambda d, name, n: F.struct(F.lit(d).alias("dimension"), name.cast("string").alias("name"), n.cast("int").alias("quota"))
    strata = F.array(
        stratum("size", size, F.when(size == "small", small).when(size == "middle", middle).otherwise(large)),
        stratum("package", F.coalesce(F.col("package"), F.lit("")), F.lit(OF_PACKAGE)),
        stratum("complexity", labels, F.lit(OF_COMPLEXITY)),
        stratum("random", F.lit("all"), F.lit(AT_RANDOM)),
    )
    each = units.select("unit", F.explode(strata).alias("s")).select("unit", "s.*")
    key = sample_key(F.col("unit"), F.col("dimension"), seed)
    rank = F.row_number().over(Window.partitionBy("dimension", "name").orderBy("_key", "unit"))
    most = max(small, middle, large, OF_PACKAGE, OF_COMPLEXITY, AT_RANDOM)
    taken = each.withColumn("_key", key).withColumn("_rank", rank).where(F.col("_rank") <= most).where(F.col("_rank") <= F.col("quota"))
    return taken.groupBy("unit").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "dimension", "name"))), ",").alias("strata"))

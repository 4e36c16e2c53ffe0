"""Fuzzy match of free country text against a country list."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import first_by

# Words without weight in country names, replacements, points.
STOP_WORDS = (
    "THE", "OF", "AND", "ISLAMIC", "BOLIVARIAN",
    "PLURINATIONAL", "PEOPLES", "DUTCH PART", "FRENCH PART",
    "MALVINAS", "YUGOSLAV", "PROTECTORATE",
    "DEM", "DEMOCRATIC", "FMR", "FORMER", "PROV", "PROVINCE",
    "REP", "REPUBLIC", "ST", "SAINT", "UTD", "U",
    "N", "NORTH", "E", "EAST", "W", "WEST", "K", "FED",
    "FEDERATION", "FEDERAL", "FEDERATED", "ISL", "ISLAND", "ISLANDS",
    "S", "TERR", "TERRITORY", "TERRITORIES", "IS", "SOUTHWEST", "SOUTHEAST",
    "NORTHEAST", "NORTHWEST",
)
REPLACEMENTS = {
    "uk": "united kingdom",
    "swaziland": "eswatini",
    "laos": "lao people's democratic republic",
}
EXACT_POINTS, SUBDIVISION_POINTS, PARTIAL_POINTS, DISTANCE_POINTS = 50, 49, 48, 45
DISTANCE_RATIO = 0.25


def cleaned(text: Column, replace: bool = True) -> Column:
    """Lower case, cut at a comma, no brackets, punctuation or stop words."""
    value = F.substring_index(F.lower(text), ",", 1)
    value = F.regexp_replace(value, r"\(.+?\)", "")
    value = F.regexp_replace(value, r"[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]", " ")
    words = "|".join(w.lower() for w in STOP_WORDS)
    value = F.trim(F.regexp_replace(value, rf"\b({words})\b", ""))
    if not replace:
        return value
    result = value
    for old, new in REPLACEMENTS.items():
        result = F.when(value == old, F.lit(new)).otherwise(result)
    return result


def _plain_letters() -> tuple[str, str]:
    """Small accented Latin letters, and the letters that they are without accents."""
    both = [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, range(0xC0, 0x250)) if c == c.lower()]
    kept = [(c, p) for c, p in both if p != c and p.isascii()]
    return "".join(c for c, _ in kept), "".join(p for _, p in kept)


def without_accents(text: Column) -> Column:
    """Small letters without accents."""
    accented, letters = _plain_letters()
    return F.translate(F.lower(text), accented, letters)


def _pairs(text: Column) -> Column:
    """The text's distinct two-letter pieces; a single letter is its own piece."""
    positions = F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1)))
    return F.array_distinct(F.transform(positions, lambda i: F.substring(text, i, F.lit(2))))


def _letters(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))


def match_countries(texts: DataFrame, column: str, countries: DataFrame, code: str, code3: str, name: str,
                    official: str, subdivisions: DataFrame | None = None, sub_code: str | None = None,
                    sub_names: tuple[str, ...] = (), common: str | None = None, numeric: str | None = None) -> DataFrame:
    """Best country per distinct text, with its score; NULL where nothing fits.

    Text of two or three letters is looked up as a code only (score NULL).
    Otherwise points add up per country: equal to a code, a number or one of its
    names 50, equal to one of the ';'-separated entries of any field of a
    subdivision 49, contained in the name or the official name 48, least edit
    distance under a quarter of the text's length 45. Names and subdivisions are
    compared without accents for the second and third. The highest sum wins,
    then the smallest code.

    Nothing is crossed. Each edit destroys at most two of the text's two-letter
    pieces, so a text nearer to a name than a quarter of its length, or contained
    in one, lacks at most so many of its pieces there. Of one more piece than
    that at least one is shared: candidates come from an equi-join on so many
    pieces, and pairs that lack too many of all are dropped before any distance.
    """
    asked = texts.select(column).filter(F.col(column).isNotNull()).distinct().withColumn(
        "_q", cleaned(F.col(column)))
    answerable = asked.filter((F.length(column) > 3) & (F.length("_q") > 0))
    codes = countries.select(F.col(code).alias("_code"), F.explode(F.array(F.upper(code), F.upper(code3))).alias("_as"))
    by_code = asked.filter(F.length(column).isin(2, 3)).join(codes, F.upper(F.col(column)) == F.col("_as")).select(
        column, "_code", F.lit(None).cast("bigint").alias("score"))

    fields = [c for c in (code, code3, name, official, common, numeric) if c is not None]
    exact = countries.select(F.col(code).alias("_code"), F.explode(F.array_distinct(F.array_compact(
        F.array(*[F.lower(F.col(c).cast("string")) for c in fields])))).alias("_as"))
    equal = answerable.join(exact, F.col("_q") == F.col("_as")).select(column, "_code", F.lit(EXACT_POINTS).alias("_points"))

    listed = countries.select(
        F.col(code).alias("_code"), without_accents(F.col(name)).alias("_name"), without_accents(F.col(official)).alias("_official"),
        cleaned(F.col(name), replace=False).alias("_clean"))
    held = F.array_distinct(F.concat(*[
        f(F.coalesce(F.col(c), F.lit(""))) for f in (_pairs, _letters) for c in ("_name", "_official", "_clean")]))
    by_piece = listed.withColumn("_held", held).withColumn("_piece", F.explode("_held"))
    edits = F.ceil(F.length("_q") * DISTANCE_RATIO) - 1
    wanted = answerable.withColumn("_all", _pairs(F.col("_q"))).withColumn("_lost", (edits * 2).cast("int"))
    probes = wanted.withColumn("_piece", F.explode(F.slice("_all", 1, F.col("_lost") + 1)))
    met = probes.join(by_piece, "_piece").filter(
        F.size(F.array_except("_all", "_held")) <= F.col("_lost")).drop("_piece", "_held", "_all", "_lost")
    candidates = met.dropDuplicates([column, "_code"])

    scored = candidates.withColumns({
        "_within": F.contains("_name", "_q") | F.coalesce(F.contains("_official", "_q"), F.lit(False)),
        "_ratio": F.levenshtein(F.col("_clean"), F.col("_q")) / F.length("_q"),
    })
    nearest = first_by(
        scored.filter(F.col("_ratio") < DISTANCE_RATIO), [column], [F.col("_ratio").asc(), F.col("_code").asc()])
    votes = equal.unionByName(
        scored.filter("_within").select(column, "_code", F.lit(PARTIAL_POINTS).alias("_points"))).unionByName(
        nearest.select(column, "_code", F.lit(DISTANCE_POINTS).alias("_points")))
    if subdivisions is not None:
        entries = F.split(without_accents(F.concat_ws(";", *[F.col(c).cast("string") for c in sub_names])), ";")
        named = subdivisions.select(F.col(sub_code).alias("_code"), F.explode(F.array_distinct(entries)).alias("_sub"))
        votes = votes.unionByName(
            answerable.join(named, F.col("_q") == F.col("_sub")).select(
                column, "_code", F.lit(SUBDIVISION_POINTS).alias("_points")))
    totals = votes.groupBy(column, "_code").agg(F.sum("_points").alias("score"))
    best = first_by(totals, [column], [F.col("score").desc(), F.col("_code").asc()]).unionByName(by_code)
    return asked.select(column).join(best, column, "left").select(
        column, F.col("_code").alias("matched_code"), "score")

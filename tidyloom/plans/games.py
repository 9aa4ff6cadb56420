"""Word scores and creature evolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyloom.functions import predicates, text
from tidyloom.operators import groups, ranks, reshape

# The six measures that make up combat power.
POWER_PARTS = ["hp", "attack", "defense", "special_attack", "special_defense", "speed"]


def clean_tiles(raw: DataFrame) -> DataFrame:
    """Points, letter and number of each tile from lines such as ``1 point: E ×12, A ×9``; a blank has no letter."""
    line = text.remove_text("Scrabble", "×")
    points = text.extract(line, r"^(\d+)").cast("long")
    tiles = raw.select(points.alias("points"), F.explode_outer(text.extract_all(line, r"(\w+)\s(\d+)")).alias("tile"))
    tile = text.replace_first("tile", "Blank", "_")
    return tiles.select(
        "points", text.extract(tile, r"([A-Z])").alias("letter"), text.extract(tile, r"(\d+)").cast("long").alias("frequency")
    )


def letters_per_word(words: DataFrame) -> DataFrame:
    letters = words.select("word", F.explode(F.split("word", "")).alias("letter"))
    return groups.count_by(letters.where(F.col("letter") != ""), "word", "letter", name="word_frequency")


def word_analysis(words: DataFrame, tiles: DataFrame) -> DataFrame:
    """Chance to draw each word and its points, both ranked; words that cannot be drawn are left out.

    Each word is worked out in one aggregation over its letters.
    """
    all_tiles = tiles.agg(F.sum("frequency").alias("n")).select("n").scalar()
    counted = letters_per_word(words.select(F.upper(F.col("word")).alias("word")).distinct())
    drawn = counted.join(tiles, "letter").withColumn("_chance", F.col("frequency") / all_tiles)
    enough = F.col("word_frequency") <= F.col("frequency")
    chance = F.product(F.when(enough, F.pow("_chance", "word_frequency")).otherwise(F.lit(0.0)))
    scored = drawn.groupBy("word").agg(chance.alias("probability"), F.sum(F.col("word_frequency") * F.col("points")).alias("total_points"))
    possible = words.select(F.upper(F.col("word")).alias("word")).join(scored.where(F.col("probability") > 0), "word")
    # Equal chances tie in whatever order their letters were multiplied: the rank
    # is that of the rounded logarithm.
    by_chance = ranks.ranked(possible.withColumn("_log", F.round(F.log("probability"), 9)), [], "_log", "probability_rank", descending=True)
    return ranks.ranked(by_chance.drop("_log"), [], "total_points", "total_points_rank", descending=True)


def evolution_gains(stats: DataFrame, evolutions: DataFrame) -> DataFrame:
    """Combat power at the first and last stage of each evolution line, and how it grew."""
    lines = reshape.rename_by(evolutions, str.lower)
    final = predicates.first_match([(F.col("stage_3").isNotNull(), F.col("stage_3")), (F.col("stage_2").isNotNull(), F.col("stage_2"))])
    finals = lines.select("stage_1", final.alias("final_stage")).where(F.col("final_stage").isNotNull())
    # A line meets only the final stages that are its own, by key.
    candidates = lines.withColumn("final_stage", F.explode(F.array_compact(F.array("stage_2", "stage_3"))))
    paired = candidates.join(finals, ["stage_1", "final_stage"])
    total = sum((F.col(part) for part in POWER_PARTS[1:]), F.col(POWER_PARTS[0]))
    first = stats.select(F.col("name").alias("stage_1"), "pokedex_number", "gen_introduced", total.alias("initial_combat_power"))
    last = stats.select(F.col("name").alias("final_stage"), total.alias("final_combat_power"))
    joined = paired.join(first, "stage_1").join(last, "final_stage")
    change = F.col("final_combat_power") / F.col("initial_combat_power")
    return joined.select(
        "stage_1", "stage_2", "stage_3", "pokedex_number", "gen_introduced", "initial_combat_power", "final_combat_power",
        change.alias("prop_change_combat_power"),
    )

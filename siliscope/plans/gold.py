"""Scored and ranked laptops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_rank

# Point lists of the scores. Each entry is (points, condition), the first that holds wins.
GAMING_TIER = [(100, ["rtx 50", "rtx 4090"]), (85, ["rtx 40", "rx 7900"]), (60, ["rtx 30", "rx 6000"])]
GAMING_TIER_ELSE = 20
DEV_RAM = [(50, 32), (30, 16)]
DEV_RAM_ELSE = 10
DEV_CPU = [(50, ["i9", "ryzen 9"]), (35, ["i7", "ryzen 7"])]
DEV_CPU_ELSE = 15
CODING_RAM = [(10, 16), (5, 8)]
CODING_RAM_ELSE = 2
CODING_CPU = [(10, ["i7", "ryzen 7"]), (7, ["i5", "ryzen 5"])]
CODING_CPU_ELSE = 3
GAMING_GPU = [(15, ["rtx 40"]), (10, ["rtx 30"]), (8, ["rx"])]
GAMING_INTEGRATED, GAMING_NO_GPU, GAMING_INTEGRATED_POINTS, GAMING_GPU_ELSE = "integrated", "no", 1, 3
GAMING_RANK, GAMING_RANK_ELSE = [(10, ["rtx"])], 1
NOT_LAPTOP_MARKS = ["Monitor", "Graphics Card", "Processor"]
WORKSTATION, GAMING, DEVOPS, ENTRY = (
    "Extreme Workstation",
    "High-End Gaming",
    "DevOps/Data Science Ready",
    "Entry Level / Student",
)
WORKSTATION_GAMING, WORKSTATION_DEV, GAMING_LEVEL, DEVOPS_LEVEL = 85, 80, 80, 60
# End of fixed values.


def points_for_words(text: Column, scale: list[tuple[int, list[str]]], otherwise: int) -> Column:
    """Points of the first entry with one of its words in the text (case matters)."""
    chain = F
    for points, words in scale:
        found = F.lit(False)
        for word in words:
            found = found | text.contains(word)
        chain = chain.when(found, points)
    return chain.otherwise(otherwise)


def points_for_size(size: Column, scale: list[tuple[int, int]], otherwise: int) -> Column:
    """Points of the first entry whose least size is reached."""
    chain = F
    for points, least in scale:
        chain = chain.when(size >= least, points)
    return chain.otherwise(otherwise)


def build_category(gaming: Column, dev: Column) -> Column:
    return (
        F.when((gaming >= WORKSTATION_GAMING) & (dev >= WORKSTATION_DEV), WORKSTATION)
        .when(gaming >= GAMING_LEVEL, GAMING)
        .when(dev >= DEVOPS_LEVEL, DEVOPS)
        .otherwise(ENTRY)
    )


def scored_hardware(laptops: DataFrame) -> DataFrame:
    """Laptops with gaming and development scores and the build category, before ranking."""
    cpu, gpu, ram = F.col("cpu_description"), F.col("gpu_description"), F.col("ram_gb")
    return (
        laptops.select("laptop_name", "brand", "cpu_description", "ram_gb", "gpu_description")
        .withColumn("gaming_tier_score", points_for_words(gpu, GAMING_TIER, GAMING_TIER_ELSE))
        .withColumn(
            "dev_score",
            points_for_size(ram, DEV_RAM, DEV_RAM_ELSE) + points_for_words(cpu, DEV_CPU, DEV_CPU_ELSE),
        )
        .withColumn("build_category", build_category(F.col("gaming_tier_score"), F.col("dev_score")))
    )


def fact_hardware_recommendations(laptops: DataFrame) -> DataFrame:
    """Laptops with scores, build category and a global rank by the sum of both scores."""
    scored = scored_hardware(laptops).withColumn("_total", F.col("gaming_tier_score") + F.col("dev_score"))
    return global_rank(scored, {"global_rank": "_total"}).drop("_total")


def not_laptop_filter(laptops: DataFrame) -> DataFrame:
    """Leave out components whose name says so."""
    out = laptops
    for mark in NOT_LAPTOP_MARKS:
        out = out.filter(~F.col("laptop_name").contains(mark))
    return out


def fact_laptop_rankings(laptops: DataFrame) -> DataFrame:
    """Laptops with coding and gaming scores; the ranks go by memory and by RTX graphics only."""
    cpu, gpu, ram = F.col("cpu_description"), F.col("gpu_description"), F.col("ram_gb")
    memory = points_for_size(ram, CODING_RAM, CODING_RAM_ELSE)
    weak = gpu.contains(GAMING_INTEGRATED) | (gpu == GAMING_NO_GPU)
    weakest = F.when(weak, GAMING_INTEGRATED_POINTS).otherwise(GAMING_GPU_ELSE)
    gaming = points_for_words(gpu, GAMING_GPU, 0)
    scored = not_laptop_filter(laptops).select(
        "laptop_name",
        "brand",
        "cpu_description",
        "ram_gb",
        "gpu_description",
        "website_source",
        (memory + points_for_words(cpu, CODING_CPU, CODING_CPU_ELSE)).alias("coding_score"),
        F.when(gaming > 0, gaming).otherwise(weakest).alias("gaming_score"),
        memory.alias("_memory"),
        points_for_words(gpu, GAMING_RANK, GAMING_RANK_ELSE).alias("_rtx"),
    )
    ranks = {"coding_rank": "_memory", "gaming_rank": "_rtx"}
    return global_rank(scored, ranks).drop("_memory", "_rtx")

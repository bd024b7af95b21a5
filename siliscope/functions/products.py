"""Classification of product names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import parsed

# Keyword lists and labels that decide brand, form factor and bundles.
CPU_BRANDS = {
    "Intel": ["intel", "core i", "xeon", "pentium", "celeron"],
    "AMD": ["amd", "ryzen", "threadripper", "athlon", "epyc"],
}
GPU_BRANDS = {
    "Nvidia": ["nvidia", "geforce", "rtx", "gtx", "quadro"],
    "AMD": ["amd", "radeon", "rx ", "vega", "navi"],
    "Intel": ["intel", "arc ", "iris"],
}
UNKNOWN_BRAND = "Unknown"
LAPTOP_RAM_WORDS = ["sodimm", "so-dimm", "laptop"]
CPU_COMBO_WORDS = ["combo", "bundle", "kit with", "+ motherboard", "+ mobo"]
GPU_COMBO_WORDS = ["combo", "bundle", "kit with", "+ psu", "+ case", "+ cpu", "+ mobo", "+ motherboard"]
DEFAULT_GENERATION = 10
# End of fixed values.

COMBO_WORDS = {"cpu": CPU_COMBO_WORDS, "gpu": GPU_COMBO_WORDS}


def mentions_any(text: Column, words: list[str]) -> Column:
    """True when the lower-cased text contains one of the words.

    One pattern instead of one test per word: the text may be a long expression
    that Spark repeats for each use when it pushes a filter down.
    """
    return F.lower(text).rlike("|".join(re.escape(word) for word in words))


def _first_matching_label(text: Column, labels: dict[str, list[str]], otherwise: str) -> Column:
    chain = F
    for label, words in labels.items():
        chain = chain.when(mentions_any(text, words), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def detect_brand_cpu(name: Column) -> Column:
    return _first_matching_label(name, CPU_BRANDS, UNKNOWN_BRAND)


def detect_brand_gpu(name: Column) -> Column:
    return _first_matching_label(name, GPU_BRANDS, UNKNOWN_BRAND)


def ram_form_factor(name: Column) -> Column:
    return F.when(mentions_any(name, LAPTOP_RAM_WORDS), F.lit("laptop")).otherwise(F.lit("desktop"))


def is_combo(name: Column, category: str | Column) -> Column:
    """True for bundles; only cpu and gpu pages have a bundle word list."""
    if isinstance(category, str):
        words = COMBO_WORDS.get(category)
        return mentions_any(name, words) if words else F.lit(False)
    chain = F
    for label, words in COMBO_WORDS.items():
        chain = chain.when(category == label, mentions_any(name, words))
    return F.coalesce(chain.otherwise(F.lit(False)), F.lit(False))


def extract_gen(name: Column) -> Column:
    """First two of the first four digits in a row, else the default generation."""
    digits = parsed(F.regexp_extract(name, r"(\d{2})\d{2}", 1), "int")
    return F.coalesce(digits, F.lit(DEFAULT_GENERATION))


def value_score(generation: Column, price: Column) -> Column:
    """Generation points per thousand of price."""
    return (generation * 10).cast("double") / (price / F.lit(1000))

"""Column expressions: bounds, rounding, parsing, names, and deterministic order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def rounded(x: Column, digits: int) -> Column:
    """Half to even on the scaled double, as array libraries round (Spark's ``round`` is decimal)."""
    return F.rint(x * F.lit(10.0**digits)) / F.lit(10.0**digits)


def finite(x: Column) -> Column:
    """NULL for NaN and infinities, so that a missing score sorts and counts as missing."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def number(text: Column) -> Column:
    """Finite number in a text, else NULL."""
    return finite(F.trim(text).try_cast("double"))


def label(text: Column) -> Column:
    """0 or 1 from numeric text, else NULL."""
    n = finite(text.try_cast("double")).try_cast("int")
    return F.when(n.isin(0, 1), n)


def probability(x: Column) -> Column:
    return rounded(clamp(x), 4)


def affinity_norm(raw: Column) -> Column:
    return clamp((raw - 4.0) / 5.0)


def combine(parts: Mapping[str, float]) -> Column:
    """Weighted sum of columns, in the given order, to four digits."""
    total = None
    for name, weight in parts.items():
        term = F.lit(weight) * F.col(name)
        total = term if total is None else total + term
    return rounded(total, 4)


FOUR_LAYER = {"l1": 0.20, "l2": 0.50, "l3": 0.20, "l4": 0.10}
THREE_LAYER = {"l1": 0.25, "l2": 0.40, "l3": 0.35}
WITHOUT_L4 = {"l1": 0.20, "l2": 0.50, "l3": 0.20}


def top_count(n: Column, fraction: float) -> Column:
    """Size of the top fraction: half to even, at least one."""
    return F.greatest(F.lit(1), F.rint(n * F.lit(float(fraction))).cast("int"))


def target_code(text: Column) -> Column:
    """First accession code in a text."""
    return F.nullif(F.regexp_extract(text, r"CHEMBL\d+", 0), F.lit(""))


def trailing_name(text: Column) -> Column:
    """Name after the accession, without structure codes."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"^.*?CHEMBL\d+", ""), r"\b[0-9][A-Za-z0-9]{3}\b", ""))


def normal_name(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), r"[_\s-]+", " ")


def slug(text: Column, fallback: str = "target", most: int = 64) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(s, 1, most), F.lit("")), F.lit(fallback))


def inferred_target(explicit: Column, prompt: Column, keywords: Mapping[str, str]) -> Column:
    """Explicit target, else an accession in the prompt, else a keyword's target, else a slug."""
    text = F.lower(F.coalesce(prompt, F.lit("")))
    named = [F.when(text.rlike(k), F.lit(v)) for k, v in keywords.items()]
    code = F.upper(F.nullif(F.regexp_extract(F.coalesce(prompt, F.lit("")), r"(?i)CHEMBL\d+", 0), F.lit("")))
    return F.coalesce(F.nullif(F.substring(F.trim(explicit), 1, 160), F.lit("")), code, *named, slug(text))


def cache_key(key: Column, namespace: str) -> Column:
    return F.sha2(F.concat(key, F.lit("\0"), F.lit(namespace)), 256)


def hash_order(seed: int | str, *keys: Column) -> Column:
    """Hex digest that orders rows the same way on any number of partitions."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256)


def box_valid(center: Column, size: Column) -> Column:
    """Three finite numbers each, sizes above zero."""
    three = lambda a: F.coalesce((F.size(a) == 3) & F.forall(a, lambda x: finite(x).isNotNull()), F.lit(False))
    return three(center) & three(size) & F.coalesce(F.forall(size, lambda x: x > 0), F.lit(False))


def threshold_label(score: Column, hi: float = 0.7, lo: float = 0.3) -> Column:
    return F.when(score >= hi, 1).when(score <= lo, 0)


def ligand_efficiency(affinity: Column, heavy_atoms: Column) -> Column:
    return rounded(F.try_divide(affinity, heavy_atoms.cast("double")), 4)


def sequence_codes(text: Column, alphabet: str, most: int) -> Column:
    """Letters as places in ``alphabet``; others get its length; at most ``most`` of them."""
    letters = F.split(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), "")
    known = F.create_map(*[x for i, c in enumerate(alphabet) for x in (F.lit(c), F.lit(i))])
    codes = F.transform(F.filter(letters, lambda c: c != ""), lambda c: F.coalesce(F.try_element_at(known, c), F.lit(len(alphabet))))
    return F.slice(codes, 1, most)

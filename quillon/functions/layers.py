"""Layer scores as column expressions: molecule quality (L1), risks (L3), gate and flags.

Properties arrive as columns: mw, logp, tpsa, hbd, hba, rotatable, heavy, rings, aromatic, aliphatic,
hetero, halogen, qed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import clamp, rounded

c = F.col


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it doesn't or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def above(x: Column, limit: float) -> Column:
    return F.greatest(F.lit(0), x - F.lit(limit))


# Limits of the four rules.
def violations() -> Column:
    return flag(c("mw") > 500) + flag(c("logp") > 5) + flag(c("hbd") > 5) + flag(c("hba") > 10)


# Limits and weights of the excess counts.
def synthesis() -> Column:
    excess = (
        above(c("rings"), 3) * 0.15 + above(c("aromatic"), 2) * 0.10 + above(c("rotatable"), 6) * 0.08 + above(c("hetero"), 6) * 0.06 + c("halogen") * 0.05 + above(c("heavy"), 35) * 0.02
    )
    return clamp(F.lit(0.95) - excess)


# The limits and weights in the scores below, and in the sub-scores and ceilings.
def quality_parts() -> dict[str, Column]:
    """Sub-scores of L1, from properties at their reported digits."""
    mw, logp, tpsa = rounded(c("mw"), 2), rounded(c("logp"), 3), rounded(c("tpsa"), 2)
    return {
        "qed": rounded(c("qed"), 4),
        "sa": rounded(synthesis(), 4),
        "lipinski": clamp(1.0 - violations() / 4.0),
        "mw": F.when(mw < 50, 0.1).when(mw < 150, 0.5 + 0.5 * (mw - 50) / 100).when(mw <= 600, 1.0).when(mw <= 800, 1.0 - (mw - 600) / 200 * 0.4).otherwise(0.2),
        "logp": F.when(logp < -2, 0.3).when(logp < -0.5, 0.5 + 0.5 * (logp + 2) / 1.5).when(logp <= 4, 1.0).when(logp <= 6, 1.0 - (logp - 4) / 2 * 0.4).otherwise(0.3),
        "tpsa": F.when(tpsa < 20, 0.4).when(tpsa <= 140, 1.0).when(tpsa <= 200, 1.0 - (tpsa - 140) / 60 * 0.5).otherwise(0.3),
        "hbd": clamp(1.0 - above(c("hbd"), 4) / 5.0),
        "hba": F.when(c("hba") < 1, 0.3).when(c("hba") <= 10, 1.0).otherwise(clamp(1.0 - (c("hba") - 10) / 6.0)),
    }


# Weights of the L1 sub-scores.
QUALITY_WEIGHTS = {"qed": 0.20, "sa": 0.15, "lipinski": 0.15, "mw": 0.12, "logp": 0.12, "tpsa": 0.10, "hbd": 0.08, "hba": 0.08}


def quality() -> Column:
    parts = quality_parts()
    total = F.lit(0.0)
    for name, weight in QUALITY_WEIGHTS.items():
        total = total + parts[name] * F.lit(weight)
    return rounded(clamp(total), 4)


# Coefficients of the solubility.
def solubility() -> Column:
    return F.lit(0.16) - 0.63 * c("logp") - 0.0062 * c("mw") + 0.066 * c("tpsa") / 100


# Limits and weights of the channel risk.
def herg() -> Column:
    return clamp(
        0.15 * flag(c("mw") > 350) + 0.1 * flag(c("mw") > 500) + 0.15 * flag(c("logp") > 3) + 0.1 * flag(c("logp") > 5) + 0.15 * flag(c("aromatic") >= 2) + 0.1 * flag(c("rotatable") > 5)
    )


# Limits and weights of the enzyme risk.
def cyp3a4() -> Column:
    return clamp(0.2 * flag(c("mw") > 400) + 0.2 * flag(c("logp") > 3) + 0.2 * flag(c("aromatic") >= 3) + 0.1 * flag(c("hba") > 5))


# Limits and weights of the enzyme risk.
def cyp2d6() -> Column:
    return clamp(0.2 * flag(c("logp") > 2.5) + 0.2 * flag(c("aromatic") >= 2) + 0.1 * flag(c("aliphatic") > 0))


# Limits and weights of the oral score.
def oral() -> Column:
    return clamp(1.0 - violations() * 0.15 - 0.1 * flag(c("rotatable") > 10) - 0.15 * flag(c("tpsa") > 140))


# Weights of alerts and the most they cost.
def alert_penalty(severe: Column, moderate: Column) -> Column:
    return clamp(severe * 0.30 + moderate * 0.22, 0.0, 0.85)


# The weight of a light molecule.
def inorganic_cyanide() -> Column:
    """A cyanide alert counts as severe on a light molecule or with an alkali metal."""
    return F.coalesce(c("cyanide") & ((c("mw") < 100) | c("alkali")), F.lit(False))


def severe_alerts() -> Column:
    """Severe alerts of the structure, and an inorganic cyanide as one more."""
    return c("severe") + flag(inorganic_cyanide())


# Weights of the parts, defaults and ceilings.
def composite() -> Column:
    """L3 from severe, moderate, tox21, clintox, sider, bbb and heavy_metal columns.

    Missing model outputs count as 0.5, and side effects as 0; alerts cap the score, the strictest
    first.  An inorganic cyanide (cyanide, alkali, mw) is a severe alert.
    """
    severe = severe_alerts()
    tox21, clintox, sider, bbb = (F.coalesce(c(n), F.lit(d)) for n, d in (("tox21", 0.5), ("clintox", 0.5), ("sider", 0.0), ("bbb", 0.5)))
    toxic = alert_penalty(severe, c("moderate")) * 0.50 + tox21 * 0.20 + clintox * 0.15 + sider * 0.15
    brain = F.when(bbb < 0.5, 1.0 - bbb).otherwise(0.3)
    organs = clamp(1.0 - (clintox * 0.4 + sider * 0.3 + herg() * 0.3))
    soluble = clamp((solubility() + 6) / 7)
    raw = clamp((1.0 - toxic) * 0.40 + organs * 0.25 + oral() * 0.15 + soluble * 0.10 + brain * 0.10)
    ceiling = F.when(c("heavy_metal") | (severe >= 2), 0.25).when(severe >= 1, 0.35).when(c("moderate") >= 2, 0.50).otherwise(1.0)
    return rounded(F.least(raw, ceiling), 4)


def flag_text(parts: list[Column]) -> Column:
    """Parts that aren't NULL, in order; ``low`` if there is none."""
    return F.coalesce(F.nullif(F.concat_ws(" | ", *parts), F.lit("")), F.lit("low"))


# The gate's limits.
GATE = {
    "weak_binding": ("l2", "<", 0.2),
    "low_admet": ("admet", "<", 0.5),
    "many_alerts": ("alerts", ">=", 2),
    "severe_alert": ("severe", ">=", 1),
    "low_oral": ("oral", "<", 0.4),
    "herg_risk": ("herg", ">", 0.6),
}


def gate_reasons() -> Column:
    """Names of the limits that a row breaks; a missing value counts as 0."""
    out = []
    for name, (column, how, limit) in GATE.items():
        x = F.coalesce(c(column).cast("double"), F.lit(0.0))
        broken = {"<": x < limit, ">=": x >= limit, ">": x > limit}[how]
        out.append(F.when(broken, F.lit(name)))
    return F.array_compact(F.array(*out))


def gate(reasons: Column) -> tuple[Column, Column]:
    """(status, reason): FAIL from two reasons on; a passing row has no reason text."""
    fails = F.size(reasons) >= 2
    return F.when(fails, "FAIL").otherwise("PASS"), F.when(fails, F.array_join(reasons, "; ")).otherwise("")

"""Region energies: edge preservation, class separability, schedules; closed forms for two features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Boundary ratio and interaction strength, by descending ratio.
BETA_RATIO = (
    0.6410440, 0.5941100, 0.5617630, 0.5195670, 0.4613010, 0.3728720, 0.2246080, 0.1375060, 0.0928173, 0.0663682, 0.0503680, 0.0397756,
    0.0327342, 0.0280129, 0.0248621, 0.0228758, 0.0212809, 0.0188605, 0.0175266, 0.0163295, 0.0157941, 0.0153300, 0.0147133,
)
BETA_VALUE = (0.05, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 1.00, 1.15, 1.40, 1.70, 2.0, 3.0)
SCHEDULE_STEP = 0.02
NEAR_ZERO = 1e-6
INACTIVE = 1e8


def beta(ratio: Column) -> Column:
    """Interaction strength for a boundary ratio: linear between the fixed values, constant beyond."""
    out = F.lit(BETA_VALUE[-1])
    for i in range(len(BETA_RATIO) - 1, 0, -1):
        slope = (BETA_VALUE[i] - BETA_VALUE[i - 1]) / (BETA_RATIO[i] - BETA_RATIO[i - 1])
        out = F.when(ratio > BETA_RATIO[i], BETA_VALUE[i - 1] + slope * (ratio - BETA_RATIO[i - 1])).otherwise(out)
    return F.when(ratio >= BETA_RATIO[0], BETA_VALUE[0]).otherwise(out)


def fisher_beta(value: Column, fisher: Column, beta1: float = 3.0, beta2: float = 0.4) -> Column:
    return value * beta1 * (fisher / beta2) / (1 + fisher / beta2)


def alpha(iteration: Column, alpha1: float, alpha2: float) -> Column:
    return alpha1 * F.pow(F.lit(alpha2), iteration) + 1


def site_penalty(strength: Column, k: Column) -> Column:
    return F.exp(-F.pow(strength / k, 2))


def log_spread(n: Column, det: Column, features: int = 2) -> Column:
    """n ln(sqrt|cov|) / features; the root is 1 for up to three pixels and at least sqrt(1e-6)."""
    root = F.when(n <= 3, F.lit(1.0)).otherwise(F.sqrt(F.greatest(det, F.lit(0.0))))
    return F.log(F.greatest(root, F.lit(NEAR_ZERO**0.5))) * n / features


def det2(xx: Column, xy: Column, yy: Column) -> Column:
    return xx * yy - xy * xy


def least_eigen2(xx: Column, xy: Column, yy: Column) -> Column:
    return (xx + yy) / 2 - F.sqrt(F.pow((xx - yy) / 2, 2) + xy * xy)


def scatter_trace(inverse: tuple[Column, Column, Column], spread: tuple[Column, Column, Column]) -> Column:
    """tr(inverse x spread) of symmetric 2x2 matrices given as (xx, xy, yy)."""
    return inverse[0] * spread[0] + 2 * inverse[1] * spread[1] + inverse[2] * spread[2]


def pixel_alpha(iteration: Column, alpha1: float, alpha2: float, features: int) -> Column:
    return alpha1 * F.pow(F.lit(alpha2), iteration) + 1 / features


def temperature(iteration: Column, start: float, decay: float = 0.98) -> Column:
    return start * F.pow(F.lit(decay), iteration)


def binary_energy(class_a: Column, class_b: Column, penalty: Column) -> Column:
    return F.when(class_a == class_b, F.lit(0.0)).otherwise(penalty)


def mask_of(value: Column, low: Column, high: Column) -> Column:
    """Valid pixels of a mask image: at or above its middle; a constant image is valid everywhere."""
    return (low == high) | (value >= (low + high) / 2)

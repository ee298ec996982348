"""Unsigned multiplicative hashing and the deterministic split rules over edge ordinals.

Spark has no unsigned 64-bit type and raises on overflow, so the product modulo ``2**64``
is computed in limbs of 22 bits, in long arithmetic that stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the 64-bit golden-ratio multiplier.
MULTIPLIER = 0x9E3779B97F4A7C15
LIMB, MASK = 22, (1 << 22) - 1
BUCKETS, TEST, VALIDATION = 10, 0, 1
#: Added to the seed for the held-out samples.
SEED_STEP = {"test": 7, "val": 11}
OVERSAMPLE = 1.5


def limbs(x: Column) -> tuple[Column, Column, Column]:
    """``x * MULTIPLIER mod 2**64`` of a non-negative long as limbs of 22, 22 and 20 bits."""
    m = [MULTIPLIER & MASK, MULTIPLIER >> LIMB & MASK, MULTIPLIER >> 2 * LIMB]
    part = [x.bitwiseAND(F.lit(MASK)), F.shiftright(x, LIMB).bitwiseAND(F.lit(MASK)), F.shiftright(x, 2 * LIMB)]
    r0 = part[0] * m[0]
    r1 = part[0] * m[1] + part[1] * m[0] + F.shiftright(r0, LIMB)
    r2 = part[0] * m[2] + part[1] * m[1] + part[2] * m[0] + F.shiftright(r1, LIMB)
    return r0.bitwiseAND(F.lit(MASK)), r1.bitwiseAND(F.lit(MASK)), r2.bitwiseAND(F.lit((1 << 20) - 1))


def _mixed(eid: Column, seed: int) -> tuple[Column, Column, Column]:
    return limbs(eid.cast("long") + F.lit(seed).cast("long"))


def hash_mod(eid: Column, seed: int, n: Column | int) -> Column:
    """The hash modulo ``n`` (below ``2**40``)."""
    a0, a1, a2 = _mixed(eid, seed)
    n = F.lit(n).cast("long") if isinstance(n, int) else n
    return (a2 * (F.lit(1 << 44) % n) + (a1 * (F.lit(1 << 22) % n)) % n + a0) % n


def sql_mod(x: str, n: int) -> str:
    """SQL for the hash of an expression modulo a small ``n``, by the same limbs."""
    m = [MULTIPLIER & MASK, MULTIPLIER >> LIMB & MASK, MULTIPLIER >> 2 * LIMB]
    p = [f"({x} & {MASK})", f"(shiftright({x}, {LIMB}) & {MASK})", f"shiftright({x}, {2 * LIMB})"]
    r0 = f"({p[0]} * {m[0]})"
    r1 = f"({p[0]} * {m[1]} + {p[1]} * {m[0]} + shiftright({r0}, {LIMB}))"
    r2 = f"({p[0]} * {m[2]} + {p[1]} * {m[1]} + {p[2]} * {m[0]} + shiftright({r1}, {LIMB}))"
    return f"((({r2} & {(1 << 20) - 1}) * {(1 << 44) % n} + ({r1} & {MASK}) * {(1 << 22) % n} + ({r0} & {MASK})) % {n})"


def split_bucket(eid: Column, seed: int = 42) -> Column:
    """0 to 9: a pure function of the edge's ordinal and the seed."""
    return hash_mod(eid, seed, BUCKETS).cast("int")


def split_name(eid: Column, seed: int = 42) -> Column:
    b = split_bucket(eid, seed)
    return F.when(b == TEST, "test").when(b == VALIDATION, "val").otherwise("train")


def top24(eid: Column, seed: int) -> Column:
    """The hash's upper 24 bits."""
    _, a1, a2 = _mixed(eid, seed)
    return F.shiftleft(a2, 4) + F.shiftright(a1, 18)


def eval_keep(eid: Column, fraction: float, seed: int) -> Column:
    """Whether a held-out edge stays in the bounded sample."""
    if fraction >= 1:
        return F.lit(True)
    return top24(eid, seed) / F.lit(float(1 << 24)) < F.lit(float(fraction))


def keep_fraction(edges: int, cap: int) -> float:
    """Share of each held-out split that is kept for a cap (0 or less: all)."""
    return 1.0 if cap <= 0 else min(1.0, OVERSAMPLE * cap / max(1, edges // 10))

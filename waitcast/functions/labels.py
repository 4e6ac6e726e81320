"""Labels, codes, clamps and advice as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# ---------------------------------------------------------------------------
SEASON_CODES = {"baja": 0, "media": 1, "alta": 2}            # season label -> code
CLASS_MINUTES = {"Corto": 10, "Medio": 30, "Largo": 60}      # wait class -> representative minutes
CLASS_LABELS = ["Corto", "Medio", "Largo"]
CROWD_LEVELS = [(15, "Bajo"), (30, "Moderado"), (60, "Alto")]  # upper bounds (exclusive); else "Muy Alto"
CROWD_TOP = "Muy Alto"
WEATHER_LABELS = {1: "Soleado", 2: "Parcialmente nublado", 3: "Nublado", 4: "Lluvia ligera",
                  5: "Lluvia fuerte/Tormenta"}
# Advice codes: one per crowd level, then peak-hour and weekend notes.
ADVICE_LEVEL = ["excelente_momento", "buen_momento", "espera_alta", "espera_muy_alta"]
ADVICE_PEAK = "hora_pico"
ADVICE_WEEKEND = "fin_de_semana"
# Output clamp policies (T8): (low, high).
CLAMPS = {"serve": (5.0, 180.0), "lambda": (1.0, 180.0), "notebook_a": (5.0, 120.0), "notebook_b": (0.0, 180.0)}
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wait_class_rule(t) -> Column:
    """F16 (rule): [5,15] Corto, (15,45] Medio, everything else (also < 5) Largo."""
    t = _c(t)
    return (F.when(t.between(5, 15), F.lit("Corto"))
            .when((t > 15) & (t <= 45), F.lit("Medio"))
            .when(t.isNotNull(), F.lit("Largo")))


def wait_class_bins(t) -> Column:
    """F16 (bins): [0,15] Corto, (15,45] Medio, (45,inf) Largo; negative -> NULL."""
    t = _c(t)
    return (F.when(t.between(0, 15), F.lit("Corto"))
            .when((t > 15) & (t <= 45), F.lit("Medio"))
            .when(t > 45, F.lit("Largo")))


def season_code(label) -> Column:
    """baja/media/alta -> 0/1/2."""
    m = F.create_map(*[x for k, v in SEASON_CODES.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(label)]


def class_minutes(label) -> Column:
    """wait class -> representative minutes."""
    m = F.create_map(*[x for k, v in CLASS_MINUTES.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(label)]


def clamp(x, policy: str = "serve", rescue: Column | None = None) -> Column:
    """clamp to the policy bounds. ``lambda`` first replaces values < 1 by ``rescue``
    (max(global median * 0.5, 5))."""
    lo, hi = CLAMPS[policy]
    x = _c(x)
    if policy == "lambda" and rescue is not None:
        x = F.when(x < 1, rescue).otherwise(x)
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


_POW2_SPLIT = {1: [8.0, 2.0], 2: [64.0, 32.0, 4.0]}


def _two_sum(a: Column, b: Column) -> tuple[Column, Column]:
    """Error-free transform: a + b == s + err exactly."""
    s = a + b
    bb = s - a
    return s, (a - (s - bb)) + (b - bb)


def round_half_even(x, digits: int = 1) -> Column:
    """Python ``round(x, digits)`` (T16): half-even on the *exact* binary value.

    ``bround`` rounds the shortest decimal string instead (158.35 -> 158.4,
    Python gives 158.3). Here x * 10^digits is formed exactly as s + e
    (10 = 8 + 2, 100 = 64 + 32 + 4: power-of-two products are exact, TwoSum
    keeps the rounding error), and the tie decision uses that exact value.
    Pure Catalyst arithmetic; no UDF.
    """
    x = _c(x)
    parts = [x * F.lit(p) for p in _POW2_SPLIT[digits]]
    s, e = _two_sum(parts[0], parts[1])
    for t in parts[2:]:
        s, e2 = _two_sum(s, t)
        e = e + e2
    k0 = F.floor(s).cast("double")
    k = F.when((s == k0) & (e < 0), k0 - 1).otherwise(k0)
    d = s - k - F.lit(0.5)
    up = (d > 0) | ((d == 0) & (e > 0)) | ((d == 0) & (e == 0) & (F.pmod(k, F.lit(2.0)) == 1))
    return (k + up.cast("double")) / F.lit(float(10 ** digits))


def crowd_level(minutes) -> Column:
    """<15 Bajo, <30 Moderado, <60 Alto, else Muy Alto."""
    m = _c(minutes)
    out = None
    for ub, lab in CROWD_LEVELS:
        out = F.when(m < ub, F.lit(lab)) if out is None else out.when(m < ub, F.lit(lab))
    return out.when(m.isNotNull(), F.lit(CROWD_TOP))


def advice(minutes, is_peak, is_weekend) -> Column:
    """ordered advice codes: crowd advice, then peak-hour and weekend notes."""
    m = _c(minutes)
    level = (F.when(m < 15, F.lit(ADVICE_LEVEL[0])).when(m < 30, F.lit(ADVICE_LEVEL[1]))
             .when(m < 60, F.lit(ADVICE_LEVEL[2])).otherwise(F.lit(ADVICE_LEVEL[3])))
    return F.array_compact(F.array(level,
                                   F.when(_c(is_peak).cast("boolean"), F.lit(ADVICE_PEAK)),
                                   F.when(_c(is_weekend).cast("boolean"), F.lit(ADVICE_WEEKEND))))


def prediction_range(pred, mae, floor: float = 5.0) -> dict[str, Column]:
    """[max(floor, round(pred - mae, 1)), round(pred + mae, 1)]."""
    p, e = _c(pred), _c(mae)
    return {"rango_min": F.greatest(F.lit(floor), round_half_even(p - e, 1)), "rango_max": round_half_even(p + e, 1)}


def bool_int(b) -> Column:
    """F27."""
    return _c(b).cast("int")


def weather_label(code) -> Column:
    """weather code -> label (5 levels)."""
    m = F.create_map(*[x for k, v in WEATHER_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(code)]

"""CASE ladders and literal label rules.

Fixed values that must equal the reference's for identical results are kept
together below, in their natural order, under "FIXED VALUES" comments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- retail
# FIXED VALUES: segment labels and their rules (first match wins)
#   rfm_score = '555'   -> Champion
#   r >= 4 and f >= 4   -> Client fidele
#   r >= 4 and f <= 2   -> Nouveau client
#   r <= 2 and f >= 3   -> Client a risque
#   r <= 2 and f <= 2   -> Client perdu
#   otherwise           -> Client moyen
def rfm_segment(rfm_score="rfm_score", r="r_score", f="f_score") -> Column:
    s, r, f = _c(rfm_score), _c(r), _c(f)
    return (F.when(s == "555", "Champion")
             .when((r >= 4) & (f >= 4), "Client fidele")
             .when((r >= 4) & (f <= 2), "Nouveau client")
             .when((r <= 2) & (f >= 3), "Client a risque")
             .when((r <= 2) & (f <= 2), "Client perdu")
             .otherwise("Client moyen"))


# FIXED VALUES: category by rfm_total
#   >= 13 VIP, >= 10 Fidele, >= 7 Regulier, >= 4 A risque, else Inactif
def rfm_category(total="rfm_total") -> Column:
    t = _c(total)
    return (F.when(t >= 13, "VIP")
             .when(t >= 10, "Fidele")
             .when(t >= 7, "Regulier")
             .when(t >= 4, "A risque")
             .otherwise("Inactif"))


# ---------------------------------------------------------------- combat log
# FIXED VALUES: consumable classes, tested in this order (first match wins)
CONSUMABLE_PATTERNS = [
    ("flask", "(?i)(flask|flacon)"),
    ("food", "(?i)(well fed|bien nourri|food|feast|festin)"),
    ("healthstone", "(?i)(healthstone|pierre de soins)"),
    ("potion", "(?i)potion"),
    ("augment_rune", "(?i)(augment rune|rune d.augmentation|crystallized augment)"),
    ("weapon_buff", "(?i)(weapon oil|huile|whetstone|sharpening stone|weightstone|pierre . aiguiser)"),
]
BUFF_TYPES = ["flask", "food", "augment_rune", "weapon_buff"]
CAST_TYPES = ["potion", "healthstone"]


def consumable_type(name) -> Column:
    n = F.coalesce(_c(name), F.lit(""))
    out = F.lit("")
    for label, pattern in reversed(CONSUMABLE_PATTERNS):
        out = F.when(n.rlike(pattern), F.lit(label)).otherwise(out)
    return out


# FIXED VALUES: difficulty ids -> label; keystone > 0 means Mythic+
DIFFICULTY_LABELS = {1: "LFR", 3: "Normal", 4: "Heroic", 5: "Mythic"}


def difficulty_label(difficulty, keystone) -> Column:
    d, k = _c(difficulty), _c(keystone)
    out = F.when(F.coalesce(k, F.lit(0)) > 0, F.lit("Mythic+"))
    for code, label in DIFFICULTY_LABELS.items():
        out = out.when(d == code, F.lit(label))
    return (out.when(d.isNotNull(), F.concat(F.lit("diff_"), d.cast("string")))
               .otherwise(F.lit("Unknown")))


def content_type(keystone, is_boss) -> Column:
    return (F.when(F.coalesce(_c(keystone), F.lit(0)) > 0, F.lit("mythic_plus"))
             .when(_c(is_boss) == 1, F.lit("raid")).otherwise(F.lit("trash")))

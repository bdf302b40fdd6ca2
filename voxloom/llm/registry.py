"""The numbered queries and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontamination import OP1_SQL, op1_decontamination
from .divergence import OP11_SQL, op11_divergence
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .language import op13_language
from .license_scan import op10_license_scan
from .near_dedup import OP6_SQL, op6_near_dedup
from .packing import op5_packing
from .pii import op3_pii
from .quality import op2_quality
from .resampling import OP12_SQL, op12_resampling
from .sharding import op7_sharding
from .substring_dedup import REPEATS_SQL, op4_substring_dedup
from .suffix_dedup import op8_suffix_dedup

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op10_license_scan": op10_license_scan,
    "op3_pii": op3_pii,
    "op5_packing": op5_packing,
    "op2_quality": op2_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_sharding": op7_sharding,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op11_divergence": op11_divergence,
    "op12_resampling": op12_resampling,
    "op13_language": op13_language,
}

ORACLE_SQL = {
    "op1_decontamination": OP1_SQL,
    "op4_substring_dedup": REPEATS_SQL,
    "op6_near_dedup": OP6_SQL,
    "op8_suffix_dedup": REPEATS_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_divergence": OP11_SQL,
    "op12_resampling": OP12_SQL,
}

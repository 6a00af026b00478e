"""The queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from .ann import op6_ann
from .decontamination import op9_decontamination
from .licenses import op4_license_scan
from .line_dedup import op7_line_dedup
from .mixing import op2_mixing
from .ngram_join import op1_ngram_jaccard_join
from .oracles import LINES, WINDOWS
from .pii import op3_pii
from .quality import op10_quality
from .sharding import op8_sharding
from .substring_dedup import op5_substring_dedup

QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_mixing, op3_pii, op4_license_scan, op5_substring_dedup, op6_ann, op7_line_dedup, op8_sharding, op9_decontamination, op10_quality)}

ORACLE_SQL: dict[str, str] = {"op7_line_dedup": LINES, "op9_decontamination": WINDOWS}

"""Queries of this subpackage and their SQL."""

from .bpe import op4
from .compaction import op10
from .cotraining import op3
from .dartminhash import op7
from .exact_dedup import SQL6, op6
from .fingerprint import op9
from .hardnegatives import SQL12, op12
from .langid import op2
from .mixing import op1
from .pii import op5
from .resampling import SQL11, op11
from .revisits import SQL8, op8
from .urlfilter import SQL13, op13

QUERIES = {
    "op1_mixing": op1,
    "op2_language_id": op2,
    "op3_quality": op3,
    "op4_byte_bpe": op4,
    "op5_personal_data": op5,
    "op6_exact_dedup": op6,
    "op7_dartminhash": op7,
    "op8_revisits": op8,
    "op9_fingerprints": op9,
    "op10_compaction": op10,
    "op11_resampling": op11,
    "op12_hard_negatives": op12,
    "op13_url_filters": op13,
}
SQL = {"op6_exact_dedup": SQL6, "op8_revisits": SQL8, "op11_resampling": SQL11, "op12_hard_negatives": SQL12, "op13_url_filters": SQL13}

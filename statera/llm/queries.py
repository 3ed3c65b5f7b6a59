"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them.

op4 and op8 add spans by learnt patterns and models, op6 and op9 are fitted models, the table of op5 is filled
in turns, op11 is approximate and op12 searches sequences; these have no SQL and are tested by brute force, recall
or held-out accuracy."""

from __future__ import annotations

from .centroids import OP13_SQL, op13_centroids
from .decontaminate import OP3_SQL, op3_decontamination
from .exact_dedup import OP1_SQL, op1_exact_dedup
from .language import op9_language
from .mixing import OP10_SQL, op10_mixing
from .near_dedup import OP7_SQL, op7_near_duplicates
from .neighbours import op11_neighbours
from .periodic import op12_periodic_runs
from .pii import op4_pii
from .quality import op6_quality
from .secrets import op8_secrets
from .sharding import op5_sharding
from .warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_decontamination": op3_decontamination,
    "op4_pii": op4_pii,
    "op5_sharding": op5_sharding,
    "op6_quality": op6_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_secrets": op8_secrets,
    "op9_language": op9_language,
    "op10_mixing": op10_mixing,
    "op11_neighbours": op11_neighbours,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_centroids": op13_centroids,
}

SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op7_near_duplicates": OP7_SQL,
    "op10_mixing": OP10_SQL,
    "op13_centroids": OP13_SQL,
}

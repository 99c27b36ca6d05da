"""The subpackage's registered queries: name -> (callable, DuckDB SQL or None)."""
from __future__ import annotations

from .bpe import op8_bpe
from .collocations import OP13_SQL, op13_collocations
from .html_text import op10_html
from .langid import op1_langid
from .linecrf import op12_crf
from .packing import op3_packing
from .periodic import op11_periodic
from .quality import op9_quality
from .records import op6_records
from .simhash import op4_simhash
from .substrings import OP7_SQL, op7_substrings
from .syncmers import op5_syncmers
from .warc import op2_warc

QUERIES = {
    "op1_langid": (op1_langid, None),
    "op2_warc": (op2_warc, None),
    "op3_packing": (op3_packing, None),
    "op4_simhash": (op4_simhash, None),
    "op5_syncmers": (op5_syncmers, None),
    "op6_records": (op6_records, None),
    "op7_substrings": (op7_substrings, OP7_SQL),
    "op8_bpe": (op8_bpe, None),
    "op9_quality": (op9_quality, None),
    "op10_html": (op10_html, None),
    "op11_periodic": (op11_periodic, None),
    "op12_crf": (op12_crf, None),
    "op13_collocations": (op13_collocations, OP13_SQL),
}

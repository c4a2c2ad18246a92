"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from .ann import op4_ann
from .exact_dedup import SQL as EXACT_SQL
from .exact_dedup import op5_exact_dedup
from .html_text import op8_html_extraction
from .language_id import language_id_pages, op7_language_id
from .line_dedup import SQL as LINE_SQL
from .line_dedup import op1_line_dedup
from .mixing import op9_mixing
from .near_dedup import op10_near_dedup
from .packing import op2_packing
from .toxicity import op6_toxicity
from .url_filter import SQL as URL_SQL
from .url_filter import op3_url_filters

QUERIES = {
    f.__name__: f
    for f in (op1_line_dedup, op2_packing, op3_url_filters, op4_ann, op5_exact_dedup, op6_toxicity, op7_language_id, op8_html_extraction, op9_mixing, op10_near_dedup, language_id_pages)
}
ORACLE_SQL = {"op1_line_dedup": LINE_SQL, "op3_url_filters": URL_SQL, "op5_exact_dedup": EXACT_SQL}

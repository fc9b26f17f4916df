"""The queries of this subpackage and the SQL of those that SQL can express."""

from orderdw.llm.decontaminate import OP6_SQL, op6_spaced_seeds
from orderdw.llm.embedding_whitening import op11_secular_whitening
from orderdw.llm.html_extract import op1_html_tag_paths
from orderdw.llm.language_ppm import op3_language_ppm
from orderdw.llm.line_dedup import OP10_SQL, op10_line_dedup
from orderdw.llm.prefix_free import op4_prefix_free
from orderdw.llm.quality import op5_quality_bayes
from orderdw.llm.sentencepiece_lattice import op9_piece_lattice
from orderdw.llm.simhash_pivots import op8_simhash_pivots
from orderdw.llm.token_alignment import op12_gallop_align
from orderdw.llm.toxicity import op13_toxic_lexicon
from orderdw.llm.url_filter import op7_url_words
from orderdw.llm.vector_search import OP2_SQL, op2_va_file

QUERIES = {
    "op1_html_tag_paths": op1_html_tag_paths,
    "op2_va_file": op2_va_file,
    "op3_language_ppm": op3_language_ppm,
    "op4_prefix_free": op4_prefix_free,
    "op5_quality_bayes": op5_quality_bayes,
    "op6_spaced_seeds": op6_spaced_seeds,
    "op7_url_words": op7_url_words,
    "op8_simhash_pivots": op8_simhash_pivots,
    "op9_piece_lattice": op9_piece_lattice,
    "op10_line_dedup": op10_line_dedup,
    "op11_secular_whitening": op11_secular_whitening,
    "op12_gallop_align": op12_gallop_align,
    "op13_toxic_lexicon": op13_toxic_lexicon,
}
ORACLE = {"op2_va_file": OP2_SQL, "op6_spaced_seeds": OP6_SQL, "op10_line_dedup": OP10_SQL}

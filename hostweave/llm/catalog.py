"""Registered queries of the corpus operators."""

from hostweave.llm.audit import OP13_SQL, op13_audit
from hostweave.llm.bpe import op4_bpe
from hostweave.llm.codebooks import OP11_SQL, op11_codes
from hostweave.llm.langid import op6_langid
from hostweave.llm.lines import OP12_SQL, op12_lines
from hostweave.llm.lm import op10_lm
from hostweave.llm.media import op9_media
from hostweave.llm.packing import op5_packing
from hostweave.llm.search import op1_search
from hostweave.llm.secrets import op3_secrets
from hostweave.llm.shards import op7_shards
from hostweave.llm.simhash import op8_simhash
from hostweave.llm.urls import op2_urls

QUERIES = {
    "op1_search": op1_search,
    "op2_urls": op2_urls,
    "op3_secrets": op3_secrets,
    "op4_bpe": op4_bpe,
    "op5_packing": op5_packing,
    "op6_langid": op6_langid,
    "op7_shards": op7_shards,
    "op8_simhash": op8_simhash,
    "op9_media": op9_media,
    "op10_lm": op10_lm,
    "op11_codes": op11_codes,
    "op12_lines": op12_lines,
    "op13_audit": op13_audit,
}

#: The others aren't expressible in the oracle's SQL (XXH64, learned models, codecs); tests
#: hold each against a brute-force version.
ORACLES: dict[str, str] = {"op11_codes": OP11_SQL, "op12_lines": OP12_SQL, "op13_audit": OP13_SQL}

"""One query per corpus operator, over its whole table.

The licence scan, line removal, spelling variants and vector codes have an SQL
counterpart. Transitive closure over bit distances, heaps, tokenizers, samplers
and learned models are outside SQL, and ``tests/llm`` holds them against brute force, round trips and held-out rows.
"""

from __future__ import annotations

from labmart.llm.collisions import op6_nearest
from labmart.llm.decontaminate import op3_decontaminate
from labmart.llm.langid import op4_langid
from labmart.llm.licenses import OP9_SQL, op9_licenses
from labmart.llm.lines import OP11_SQL, op11_lines
from labmart.llm.orchard import OP13_SQL, op13_orchard
from labmart.llm.packing import op5_packing
from labmart.llm.pitman_yor import op8_pitman_yor
from labmart.llm.quality import op10_quality
from labmart.llm.shards import op7_shards
from labmart.llm.simhash import op1_simhash
from labmart.llm.spelling import OP12_SQL, op12_spelling
from labmart.llm.token_blocks import op2_token_ids

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_ids": op2_token_ids,
    "op3_decontaminate": op3_decontaminate,
    "op4_langid": op4_langid,
    "op5_packing": op5_packing,
    "op6_nearest": op6_nearest,
    "op7_shards": op7_shards,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_lines": op11_lines,
    "op12_spelling": op12_spelling,
    "op13_orchard": op13_orchard,
}
ORACLE = {
    "op9_licenses": OP9_SQL,
    "op11_lines": OP11_SQL,
    "op12_spelling": OP12_SQL,
    "op13_orchard": OP13_SQL,
}

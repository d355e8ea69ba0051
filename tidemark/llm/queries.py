"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import (alignment, ann, bpe, divergence, editprint, langid, linededup, lm, mixing, quality,
                          secrets, simhash, warc)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_langid": langid.op2_langid,
    "op3_ann": ann.op3_ann,
    "op4_secrets": secrets.op4_secrets,
    "op5_quality": quality.op5_quality,
    "op6_bpe": bpe.op6_bpe,
    "op7_lm": lm.op7_lm,
    "op8_editprint": editprint.op8_editprint,
    "op9_simhash": simhash.op9_simhash,
    "op10_mixing": mixing.op10_mixing,
    "op11_linededup": linededup.op11_linededup,
    "op12_alignment": alignment.op12_alignment,
    "op13_divergence": divergence.op13_divergence,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_warc": warc.OP1_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_linededup": linededup.OP11_SQL,
    "op13_divergence": divergence.OP13_SQL,
}

"""Registered queries of the training-data operators."""

from __future__ import annotations

from .brown import op2_brown
from .conversations import op13_repair
from .decontaminate import op4_decontaminate
from .html import op7_html
from .langid import op9_language_id
from .middle import op12_middle
from .mixing import op8_mixing
from .quality import op3_quality
from .setsketch import op6_setsketch
from .suffixes import op11_suffixes
from .tokens import op5_token_ids
from .toxicity import op1_toxicity
from .warc import op10_warc

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_brown": op2_brown,
    "op3_quality": op3_quality,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_ids": op5_token_ids,
    "op6_setsketch": op6_setsketch,
    "op7_html": op7_html,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_warc": op10_warc,
    "op11_suffixes": op11_suffixes,
    "op12_middle": op12_middle,
    "op13_repair": op13_repair,
}

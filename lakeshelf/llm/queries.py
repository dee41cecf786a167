"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from lakeshelf.llm import centroids, chat, decontaminate, licenses, linecrf, lines, neardup, periods, pieces, quality, repair, substrings, suffixes

QUERIES = {
    "op1_pieces": pieces.op1_pieces,
    "op2_licenses": licenses.op2_licenses,
    "op3_substrings": substrings.op3_substrings,
    "op4_quality": quality.op4_quality,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_repair": repair.op6_repair,
    "op7_neardup": neardup.op7_neardup,
    "op8_chat": chat.op8_chat,
    "op9_suffixes": suffixes.op9_suffixes,
    "op10_lines": lines.op10_lines,
    "op11_centroids": centroids.op11_centroids,
    "op12_linecrf": linecrf.op12_linecrf,
    "op13_periods": periods.op13_periods,
}

ORACLE = {
    "op2_licenses": licenses.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op8_chat": chat.OP8_SQL,
    "op10_lines": lines.OP10_SQL,
    "op11_centroids": centroids.OP11_SQL,
}

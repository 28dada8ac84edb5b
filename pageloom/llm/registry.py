"""Queries of this subpackage by name, and their SQL where there is any."""

from __future__ import annotations

from . import chunks, exact, infill, interpolation, jaccard, language, mixing, packing, repeats, token_trees, vectors, warc, whitening

QUERIES = {
    "op1_near_vectors": vectors.op1_near_vectors,
    "op2_chunks": chunks.op2_chunks,
    "op3_exact_dedup": exact.op3_exact_dedup,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_packing": packing.op5_packing,
    "op6_warc": warc.op6_warc,
    "op7_token_trees": token_trees.op7_token_trees,
    "op8_mixing": mixing.op8_mixing,
    "op8_mixing_weighted": mixing.op8_mixing_weighted,
    "op9_language": language.op9_language,
    "op10_repeats": repeats.op10_repeats,
    "op11_interpolation": interpolation.op11_interpolation,
    "op12_infill": infill.op12_infill,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {"op3_exact_dedup": exact.OP3_SQL, "op6_warc": warc.OP6_SQL, "op12_infill": infill.OP12_SQL}

"""The queries opN_<name>, each applying one operator to its whole table, and their SQL."""

from twinview.llm import (
    chunks,
    hnsw,
    lines,
    middle,
    mix,
    near,
    pivots,
    repeats,
    spectrum,
    suffixes,
    toxicity,
    transducer,
    warc,
)

QUERIES = {
    "op1_transducer_counts": transducer.op1_transducer_counts,
    "op2_hamming_join": near.op2_hamming_join,
    "op3_sainte_lague_mix": mix.op3_sainte_lague_mix,
    "op4_warc_segments": warc.op4_warc_segments,
    "op5_count_min_windows": repeats.op5_count_min_windows,
    "op6_line_frequency": lines.op6_line_frequency,
    "op7_chunk_table": chunks.op7_chunk_table,
    "op8_noisy_channel": toxicity.op8_noisy_channel,
    "op9_induced_suffixes": suffixes.op9_induced_suffixes,
    "op10_hnsw_shards": hnsw.op10_hnsw_shards,
    "op11_block_rotation": middle.op11_block_rotation,
    "op12_pivot_range_join": pivots.op12_pivot_range_join,
    "op13_spectrum_slicing": spectrum.op13_spectrum_slicing,
}
ORACLES = {
    "op2_hamming_join": near.ORACLE,
    "op3_sainte_lague_mix": mix.ORACLE,
    "op4_warc_segments": warc.ORACLE,
    "op5_count_min_windows": repeats.ORACLE,
    "op6_line_frequency": lines.ORACLE,
    "op9_induced_suffixes": suffixes.ORACLE,
    "op11_block_rotation": middle.ORACLE,
    "op12_pivot_range_join": pivots.ORACLE,
}

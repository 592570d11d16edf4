"""Queries of the operators and the SQL twins of those that SQL can express."""

from __future__ import annotations

from wardflow.llm import bloom_lm, crf_language, crf_secrets, decontaminate, fill_middle, hyperminhash, line_dedup, max_sketch, source_mix, token_counts, token_output, toxicity, voronoi_knn

QUERIES = {f.__name__: f for f in (line_dedup.op1_line_dedup, token_output.op2_token_output, bloom_lm.op3_bloom_lm, voronoi_knn.op4_voronoi_knn, source_mix.op5_source_mix, toxicity.op6_toxicity, token_counts.op7_token_counts, crf_language.op8_crf_language, decontaminate.op9_decontaminate,
                                  hyperminhash.op10_hyperminhash, max_sketch.op11_max_sketch, crf_secrets.op12_crf_secrets, fill_middle.op13_fill_middle)}
ORACLE = {"op1_line_dedup": line_dedup.SQL, "op4_voronoi_knn": voronoi_knn.SQL, "op5_source_mix": source_mix.SQL, "op9_decontaminate": decontaminate.SQL,
          "op10_hyperminhash": hyperminhash.SQL, "op11_max_sketch": max_sketch.SQL, "op13_fill_middle": fill_middle.SQL}

"""The queries of this subpackage by name, with SQL where SQL can express them."""

from . import centroids, decontaminate, divergence, katz, language, lines, minhash, mixing, secrets, shards, suffixes, topk, warc

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_warc_captures": warc.op3_warc_captures,
    "op4_suffix_dedup": suffixes.op4_suffix_dedup,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_katz_scores": katz.op6_katz_scores,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_language_id": language.op8_language_id,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_top_k": topk.op10_top_k,
    "op11_shard_shuffle": shards.op11_shard_shuffle,
    "op12_centroid_clusters": centroids.op12_centroid_clusters,
    "op13_source_divergence": divergence.op13_source_divergence,
}

ORACLES = {
    "op1_minhash_dedup": minhash.OP1_SQL,
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op3_warc_captures": warc.OP3_SQL,
    "op5_line_dedup": lines.OP5_SQL,
    "op7_mix_sources": mixing.OP7_SQL,
    "op9_secret_scan": secrets.OP9_SQL,
    "op10_top_k": topk.OP10_SQL,
    "op12_centroid_clusters": centroids.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}

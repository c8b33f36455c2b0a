"""The queries of this package and the SQL that checks them, as the driver registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waterline.llm.bpe import op12_bpe_pair_index
from waterline.llm.collocations import OP11_SQL, op11_hat_trie_collocations
from waterline.llm.conversations import op13_conversation_repair
from waterline.llm.embeddings import op7_embedding_neardup
from waterline.llm.idstore import op10_zstd_dictionary_store
from waterline.llm.langid import op6_language_cross_parsing
from waterline.llm.mixing import OP5_SQL, op5_mix_water_filling
from waterline.llm.packing import op1_pack_karmarkar_karp
from waterline.llm.quality import op8_hierarchical_quality
from waterline.llm.sharding import op2_shard_hypergeometric
from waterline.llm.simhash import op3_simhash_neardup
from waterline.llm.url_lists import OP4_SQL, op4_temporal_url_lists
from waterline.llm.vptree import op9_vantage_point_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack_karmarkar_karp,
        op2_shard_hypergeometric,
        op3_simhash_neardup,
        op4_temporal_url_lists,
        op5_mix_water_filling,
        op6_language_cross_parsing,
        op7_embedding_neardup,
        op8_hierarchical_quality,
        op9_vantage_point_search,
        op10_zstd_dictionary_store,
        op11_hat_trie_collocations,
        op12_bpe_pair_index,
        op13_conversation_repair,
    )
}

#: The others can't be said in SQL; tests/llm holds them against brute force, round trips or held-out labels.
ORACLES = {"op4_temporal_url_lists": OP4_SQL, "op5_mix_water_filling": OP5_SQL, "op11_hat_trie_collocations": OP11_SQL}

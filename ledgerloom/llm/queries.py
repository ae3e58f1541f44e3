"""Registered queries of the corpus operators, and their checking SQL where SQL can say it."""

from ledgerloom.llm import alignment, debruijn, imatch, mixing, neighbours, packing, parity, pseudo_likelihood, simhash, spelling, suffix_dedup, token_counts, toxicity
from ledgerloom.llm.common import documents

QUERIES, CHECKS = {}, {}


def query(name, check=None):
    def register(function):
        QUERIES[name] = function
        if check:
            CHECKS[name] = check
        return function

    return register


@query("op9_simhash_components")
def op9(spark, folder):
    return simhash.near_duplicates(documents(spark, folder), words=3, radius=2)


@query("op10_packed_pieces")
def op10(spark, folder):
    return packing.pack(documents(spark, folder))


@query("op2_mixed_sources", mixing.SQL)
def op2(spark, folder):
    return mixing.mix(documents(spark, folder))


@query("op1_token_counts")
def op1(spark, folder):
    return token_counts.token_counts(documents(spark, folder))


@query("op3_imatch_fingerprints")
def op3(spark, folder):
    return imatch.fingerprints(documents(spark, folder))


@query("op5_suffix_array_removals")
def op5(spark, folder):
    return suffix_dedup.removals(documents(spark, folder))


@query("op6_debruijn_removals")
def op6(spark, folder):
    return debruijn.removals(documents(spark, folder))


@query("op8_toxicity")
def op8(spark, folder):
    docs = documents(spark, folder)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


@query("op7_learned_partition_search")
def op7(spark, folder):
    return neighbours.search(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op4_pseudo_likelihood")
def op4(spark, folder):
    docs = documents(spark, folder)
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


@query("op13_spelling_variants")
def op13(spark, folder):
    return spelling.variant_groups(documents(spark, folder))


@query("op12_parity_components")
def op12(spark, folder):
    return parity.joined(documents(spark, folder), words=3, least=90)


@query("op11_token_alignment")
def op11(spark, folder):
    return alignment.aligned(documents(spark, folder))

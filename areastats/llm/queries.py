"""The queries of the corpus operators, each over its whole tables, and their SQL checks."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from areastats.llm import bpe, decontamination, embeddings, language, mixing, periodic, pii, quality, simhash, toxicity, urls, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a function of a table reader; `check` is the same query as SQL."""

    def add(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if check is not None:
            CHECKS[name] = check
        return fn

    return add


@query("op1_warc_index", warc.WARC_SQL)
def _warc(table):
    found = warc.archived(table("pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_pii_boosting")
def _pii(table):
    return pii.digest(pii.personal_data(table("documents")))


@query("op3_mix_sources", mixing.MIX_SQL + "SELECT doc_id, size, source_size, target, copies * size AS taken FROM passed")
def _mix(table):
    return mixing.mix(table("documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op4_toxicity")
def _toxicity(table):
    return toxicity.toxicity(table("documents"), table("labels"))


@query("op5_simhash_bktree")
def _simhash(table):
    return simhash.simhash_components(table("documents"))


@query("op6_embedding_tiles")
def _embeddings(table):
    return embeddings.linked(table("embeddings"))


@query("op7_language_bayes")
def _language(table):
    return language.languages(table("documents"))


@query("op8_decontamination")
def _decontamination(table):
    return decontamination.contaminated(table("documents"), table("benchmark"))


@query("op9_url_rules", urls.URLS_SQL)
def _urls(table):
    return urls.judged(table("pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op10_quality_rules")
def _quality(table):
    return quality.quality(table("documents"), table("labels"))


@query("op11_whitening")
def _whitening(table):
    return whitening.whitened(table("embeddings"))


@query("op12_byte_bpe")
def _byte_bpe(table):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digest(bpe.decoded(bpe.encoded(table("documents"), path, pattern), path, pattern))


@query("op13_periodic_runs")
def _periodic_runs(table):
    docs = table("documents").select("doc_id", periodic.looped(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.digest(periodic.periodic_runs(docs))

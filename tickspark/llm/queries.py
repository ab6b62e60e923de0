"""The registered queries of this subpackage, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chat, lexical, line_dedup, ngram_join, oracle, packing, pii, quality, token_counts, topk, whitening, window_dedup
from .common import tune, write_shared

#: The vocabulary that the contracts name; operators take any path.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    ids = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary())
    digests = ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"))
    decoded = bpe.decode_documents(digests, vocabulary())
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: The key of the pseudonyms; a deployment passes its own to the operator.
PSEUDONYM_KEY = b"a public key for tests"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return out.select("doc_id", "text", F.size("spans").cast("long").alias("n_found"), F.array_join(F.sort_array(F.array_distinct("spans.kind")), ",").alias("kinds"))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: Arguments of the one tool of the conversations: what was said, where, and after which answer.
REPLY = {
    "type": "object",
    "required": ["prompt", "turn"],
    "properties": {"prompt": {"type": "string", "minLength": 1, "maxLength": 100_000}, "turn": {"type": "integer", "minimum": 0}, "after": {"type": ["string", "null"]}, "notes": {"type": "array", "items": {"type": "object"}}},
    "additionalProperties": False,
}
#: Arguments of a turn that is neither a user's nor an assistant's and has no user turn next to it.
NOTE = {"type": "object", "required": ["text", "turn"], "properties": {"role": {"type": "string"}, "text": {"type": "string"}, "turn": {"type": "integer"}}, "additionalProperties": False}


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn calls the tool ``reply``, using the answer before it; the next assistant turn is the result.

    Turns of other roles (system) are ``notes`` among the arguments of the user turn after
    them; without one, each is a call of its own, ``note``.
    """
    said = table(spark, sf_dir, "conversations")
    name = lambda turn: F.concat_ws(":", "conv_id", turn)
    other = F.when(F.expr("role is null or role not in ('user', 'assistant')"), F.struct("role", "text", "turn"))
    before = said.filter("role is null or role <> 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), (F.col("role") == "assistant").alias("answer"), other.alias("note"))
    before = before.groupBy("conv_id", "turn").agg(F.max("answer").alias("answered"), F.sort_array(F.collect_list("note")).alias("notes"))
    # one join for all: user turns with what stands before them, and notes without a user turn
    both = said.filter("role = 'user'").select("conv_id", "turn", F.struct("text").alias("user")).join(before, ["conv_id", "turn"], "full")
    after = F.when(F.col("answered"), F.struct(name(F.col("turn") - 2).alias("$result")))
    reply = F.struct(F.col("user.text").alias("prompt"), "turn", after.alias("after"), F.when(F.size("notes") > 0, F.col("notes")).alias("notes"))
    call = lambda turn, tool, arguments: F.struct(turn.alias("turn"), F.lit(tool).alias("name"), F.to_json(arguments).alias("arguments"))
    made = F.when(F.col("user").isNotNull(), F.array(call(F.col("turn"), "reply", reply))).otherwise(F.transform("notes", lambda n: call(n["turn"], "note", n)))
    calls = both.select("conv_id", F.inline(made)).select("conv_id", "turn", F.lit(0).alias("pos"), name(F.col("turn")).alias("call_id"), "name", "arguments")
    results = said.filter("role = 'assistant'").select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    linked = chat.link_calls(calls, results, {"reply": REPLY, "note": NOTE})
    return linked.select("conv_id", "level", "turn", "call_id", "valid", F.array_join("errors", "; ").alias("errors"), "n_results", "result_turn", "json")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.cut_documents(docs, vocabulary()).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packing.place_pieces(write_shared(pieces, "pieces")).drop("piece")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_removed", F.size("blocks").cast("long").alias("n_blocks"), "emptied", F.sha2("kept", 256).alias("kept_sha256"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op10_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = window_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def in_steps(vector: str = "embedding") -> F.Column:
    """A vector as long integers, 64 steps to one; null where it, or an entry of it, is null or not finite.

    Entries that a double can't tell apart by whole steps any more are an error.
    """
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    step = lambda c: F.when(F.abs(64 * c) < 2.0**53, F.floor(64 * c) + 1_000_000).otherwise(F.raise_error(F.lit("an entry is too large")).cast("long"))
    return F.when(sound, F.transform(v, step))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it doesn't fit a long."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", in_steps().alias("x"))
    model = whitening.fit(vectors)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = whitening.whiten(vectors, model).select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("k", "whitened"))
    part = F.element_at(F.array(*map(F.lit, model.explained)).cast("array<double>"), F.col("k") + 1)
    return rows.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", part.alias("explained"), F.lit(model.identity_error).alias("identity_error"))


#: Tokens above which a document is over the limit.
TOKEN_LIMIT = 2048


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fit_chars``: how many characters of the document the longest prefix within the limit has."""
    tune(spark)
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), (TOKEN_LIMIT,))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), F.col("fits")[0].alias("fit_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_topk": op2_topk,
    "op3_pii": op3_pii,
    "op4_quality": op4_quality,
    "op5_chat": op5_chat,
    "op6_ann": op6_ann,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_ngram_join": op9_ngram_join,
    "op10_window_dedup": op10_window_dedup,
    "op11_lexical": op11_lexical,
    "op12_whitening": op12_whitening,
    "op13_token_counts": op13_token_counts,
}
ORACLE_SQL: dict[str, str] = oracle.SQL

"""One registered query per operator, over its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.llm import chat, quality, toxicity
from lakeweir.llm.alignment import align_tokens
from lakeweir.llm.decontamination import find_benchmark
from lakeweir.llm.embedding_dedup import near_vectors
from lakeweir.llm.ngram_join import near_duplicates
from lakeweir.llm.packing import pack
from lakeweir.llm.prefix_trie import placed_turns, prefix_trie
from lakeweir.llm.quality_rules import BASE, STRICT, evaluate_rules, passes
from lakeweir.llm.samples import held_out
from lakeweir.llm.scans import scanned
from lakeweir.llm.shipping import ship_package
from lakeweir.llm.substring_dedup import remove_repeats
from lakeweir.llm.storage import Workspace
from lakeweir.llm.token_counts import apply_edits, count_tokens
from lakeweir.llm.warc import id_of, read_archive, write_archive
from lakeweir.queries.base import Query


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    models = toxicity.train(
        documents,
        labels.filter(~held_out(F.col("doc_id"), 3, 1)),
        documents.filter(~held_out(F.col("doc_id"), 3, 1)),
    )
    return toxicity.score_toxicity(documents, models).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(read(spark, sf_dir, "documents"), tokenizer, end_id=2).select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality.train(documents, labels.filter(~held_out(F.col("doc_id"), 5, 0)))
    return quality.score_quality(documents, model).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def raw_turns(conversations: DataFrame) -> DataFrame:
    """The turns as a transcript would show them: ``conv_id``, ``turn``, ``role``, ``before``, ``text``.

    The way to mark speakers depends on the conversation; an eighth of the turns are not marked.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0
    other = F.when(F.col("role") == "user", "Human").otherwise(F.initcap("role"))
    letter = F.element_at(
        F.create_map(*map(F.lit, ["user", "Q", "assistant", "A", "system", "Context"])),
        F.coalesce("role", F.lit("")),
    )
    marker = (
        F.when(style == 0, F.concat(F.initcap("role"), F.lit(": ")))
        .when(style == 1, F.concat(F.lit("### "), other, F.lit(":\n")))
        .when(style == 2, F.concat(F.lit("["), F.upper("role"), F.lit("] ")))
        .when(style == 3, F.concat(letter, F.lit(": ")))
        .otherwise(F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
    )
    text = F.concat(
        F.lit("\n"), F.when(lost, "").otherwise(F.coalesce(marker, F.lit(""))), F.coalesce("text", F.lit(""))
    )
    # Turns are numbered, so the role before is found by number, not by sorting conversations.
    before = conversations.select(
        F.col("conv_id").alias("b_conv"), (F.col("turn") + 1).alias("b_turn"), F.col("role").alias("before")
    ).groupBy("b_conv", "b_turn").agg(F.min("before").alias("before"))
    same = (F.col("conv_id") == F.col("b_conv")) & (F.col("turn") == F.col("b_turn"))
    return conversations.join(before, same, "left").select(
        "conv_id", "turn", "role", "before", text.alias("text")
    )


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = raw_turns(read(spark, sf_dir, "conversations"))
    # Half of the conversations teach the model.
    model = chat.train(turns.filter(F.crc32(F.col("conv_id").cast("string")) % 2 == 0))
    parsed = chat.parse_transcripts(turns, model, "conv_id", "turn")
    return parsed.select(
        F.col("id").alias("conv_id"), F.col("seq").alias("turn"), "roles", "rendered"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archive(write_archive(read(spark, sf_dir, "pages")))
    return records.select(
        F.col("id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        "record_type",
        id_of(F.col("refers_to"), "bigint").alias("refers_to"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def derived_edits(documents: DataFrame) -> DataFrame:
    """A deletion, an insertion and a replacement per document, at places taken from its id."""
    size = F.coalesce(F.length("text"), F.lit(0))

    def place(salt: int) -> F.Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.greatest(size, F.lit(1)).cast("bigint"))

    def edit(salt: int, length: int, value: str) -> F.Column:
        start = place(salt)
        return F.struct(
            start.alias("start"), (start + length).alias("stop"), F.lit(value).alias("value")
        )

    edits = F.array(edit(1, 12, ""), edit(2, 0, " added words"), edit(3, 5, "other"))
    return documents.select("doc_id", F.inline(edits))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    work = Workspace(spark, "token-counts")
    state = work.store(count_tokens(documents, tokenizer), "state")
    counted = apply_edits(documents, state, derived_edits(documents), tokenizer)
    return counted.select(
        F.col("id").alias("doc_id"), "n_before", "n_tokens", "n_encoded", "n_ignored"
    )


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokens(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return aligned.withColumnRenamed("id", "doc_id").withColumn("doc_id", F.col("doc_id").cast("bigint"))


def rebuilt_turns(turns: DataFrame, ids: DataFrame, work: Workspace) -> DataFrame:
    """Turns of conversations of which the first few were replaced by those of every twentieth one."""
    h = F.crc32(F.col("conv").cast("string")) % 4
    kept = turns.filter(F.col("place") >= h).withColumn("side", F.lit(1))
    # At most 20 conversations share a base, and at most 3 of its turns are taken.
    base = turns.filter("conv % 20 = 0 and place < 3").withColumnRenamed("conv", "base")
    members = ids.select("conv", (F.col("conv") - F.col("conv") % 20).alias("base"), h.alias("h"))
    taken = base.join(members.filter("h > 0"), "base").filter("place < h").withColumn("side", F.lit(0))
    names = ["conv", "side", F.col("place").alias("original"), "digest", "n_words"]
    rows = taken.select(*names).union(kept.select(*names))
    return scanned(rows, work, ["conv"], ["side", "original"]).select(
        "conv", "place", "digest", "n_words"
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    work = Workspace(spark, "prefix-trie")
    turns = placed_turns(conversations, work)
    ids = turns.filter("place = 0").select("conv")
    return prefix_trie(rebuilt_turns(turns, ids, work), ids, work)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate_rules(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        passes(STRICT).alias("kept"),
    )


SQL3 = """
with recursive part as (
    select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as k
    from embeddings
), bad as (
    select vec_id from part group by vec_id
    having count(*) <> count(x) or not bool_and(isfinite(x)) or sum(x * x) = 0
), vec as (
    select vec_id, embedding::double[] as e,
           sqrt(list_inner_product(embedding::double[], embedding::double[])) as size
    from embeddings where embedding is not null and vec_id not in (select vec_id from bad)
), link as (
    select a.vec_id as a, b.vec_id as b from vec a join vec b on a.vec_id <> b.vec_id
    where list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.95
), reach(vec_id, other) as (
    select a, b from link
    union
    select reach.vec_id, link.b from reach join link on reach.other = link.a
), counted as (
    select a as vec_id, count(*) as n_links from link group by a
)
select vec_id, coalesce(any_value(n_links), 0) as n_links,
       least(vec_id, min(other)) as component_id,
       least(vec_id, min(other)) = vec_id as kept
from embeddings left join counted using (vec_id) left join reach using (vec_id) group by vec_id
"""

SQL4 = r"""
with recursive doc as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x{20}\x{9}-\x{D}]+'), lambda x: x <> '') as words
    from documents
), shingle as (
    select distinct doc_id, array_to_string(list_slice(words, pos, pos + 4), ' ') as s
    from doc, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as t(pos)
    where len(words) > 0
), size as (
    select doc_id, count(*) as n from shingle group by doc_id
), overlap as (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from shingle x join shingle y on x.s = y.s and x.doc_id <> y.doc_id group by all
), link as (
    select a, b from overlap join size p on p.doc_id = a join size q on q.doc_id = b
    where 100 * common >= 80 * (p.n + q.n - common)
), reach(doc_id, other) as (
    select a, b from link
    union
    select reach.doc_id, link.b from reach join link on reach.other = link.a
)
select doc_id, coalesce(any_value(n), 0) as n_shingles,
       least(doc_id, min(other)) as component_id
from doc left join size using (doc_id) left join reach using (doc_id) group by doc_id
"""

SQL6 = r"""
with doc as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
        '[\x{20}\x{9}-\x{D}]+'), lambda x: x <> '') as words
    from documents
), run as (
    select doc_id, pos, array_to_string(list_slice(words, pos, pos + 19), ' ') as run
    from doc, unnest(range(1, len(words) - 18)) as t(pos)
), again as (
    select doc_id, pos from run
    qualify row_number() over (partition by run order by doc_id, pos) > 1
), covered as (
    select distinct doc_id, pos + k as pos from again, unnest(range(0, 20)) as t(k)
), word as (
    select doc_id, pos, words[pos] as word from doc, unnest(range(1, len(words) + 1)) as t(pos)
), kept as (
    select doc_id, string_agg(word, ' ' order by pos) as text, count(*) as n
    from word anti join covered using (doc_id, pos) group by doc_id
)
select doc_id, cast(len(words) as bigint) as n_words, len(words) - coalesce(n, 0) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from doc left join kept using (doc_id)
"""

SQL8 = """
with page as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes,
           sha1(coalesce(html, '')) as payload_digest
    from pages
), owned as (
    select *, max(page_id) over (partition by payload_digest) as owner from page
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> owner then 'revisit' else 'response' end
           as record_type,
       case when payload_bytes >= 1000 and page_id <> owner then owner end as refers_to
from owned
"""

SQL9 = r"""
with doc as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') as words
    from documents
), item as (
    select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), lambda x: x <> '') as words
    from benchmark
), item_window as (
    select distinct item_id, least(10, len(words)) as size,
           array_to_string(list_slice(words, pos, pos + 9), ' ') as run
    from item, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as t(pos)
    where len(words) > 0
), sizes as (
    select distinct size from item_window
), doc_window as (
    select doc_id, pos, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') as run
    from doc, sizes, unnest(range(1, len(words) - size + 2)) as t(pos)
), hit as (
    select doc_id, pos, d.size, item_id
    from doc_window d join item_window i on d.size = i.size and d.run = i.run
), covered as (
    select doc_id, count(distinct pos + k) as n_hit
    from hit, unnest(range(0, size)) as t(k) group by doc_id
), items as (
    select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256
    from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       n_hit is not null as contaminated
from doc left join covered using (doc_id) left join items using (doc_id)
"""

SQL12 = r"""
with numbered as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
               coalesce(text, '')) - 1 as place
    from conversations where conv_id is not null
), listed as (
    select conv_id, list(struct_pack(role := role, text := text) order by place) as turns,
           list_reduce(list_prepend(4294967295::bigint, list_transform(
               string_split(cast(conv_id as varchar), ''), lambda x: ascii(x)::bigint)),
               lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)),
                   lambda a, k: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end))
               as state
    from numbered group by conv_id
), conv as (
    select c.conv_id, xor(c.state, 4294967295) % 4 as h, c.turns as own, b.turns as base
    from listed c left join listed b on b.conv_id = c.conv_id - c.conv_id % 20
), rebuilt as (
    select conv_id, list_concat(case when h = 0 or base is null then [] else base[1:h] end,
                                own[h + 1:]) as turns
    from conv
), prefix as (
    select conv_id, d, md5(cast(turns[1:d] as json)::varchar) as name,
           md5(cast(turns[1:d - 1] as json)::varchar) as parent, turns[d].text as text,
           d = len(turns) as ends, turns
    from rebuilt, unnest(range(0, len(turns) + 1)) as t(d)
), node as (
    select d, name, min(conv_id) as conv_id, any_value(parent) as parent, count(*) as n_convs,
           coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')
               as ends,
           case when d = 0 then 0 else (count(*) - 1) * len(list_filter(regexp_split_to_array(
               any_value(text), '[\x{20}\x{9}-\x{D}]+'), lambda x: x <> '')) end as saved,
           any_value(turns[1:d]) as turns
    from prefix group by d, name
), child as (
    select d - 1 as d, parent as name, count(*) as n from node where d > 0 group by all
), up as (
    select a.up as d, md5(cast(turns[1:a.up] as json)::varchar) as name, saved,
           child.n is null as leaf
    from node left join child using (d, name), unnest(range(0, d + 1)) as a(up)
), subtree as (
    select d, name, sum(saved) as saved, count(*) filter (leaf) as leaves from up group by all
)
select node.conv_id, node.d as depth, p.conv_id as parent_conv_id, node.n_convs,
       coalesce(child.n, 0) as n_children, subtree.leaves as n_leaves,
       cast(subtree.saved as bigint) as saved_tokens, sha256(node.ends) as ends_sha256
from node join subtree on node.d = subtree.d and node.name = subtree.name
left join child on node.d = child.d and node.name = child.name
left join node p on p.d = node.d - 1 and p.name = node.parent and node.d > 0
"""

SQL13 = r"""
with doc as (
    select row_number() over () as row, doc_id, coalesce(text, '') as text,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x{20}\x{9}-\x{D}]+'),
               lambda x: x <> '') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
               lambda x: regexp_matches(x, '[^\x{20}\x{9}-\x{D}]')) as lines
    from documents
), run as (
    select row, pos, array_to_string(list_slice(words, pos, pos + 4), ' ') as run
    from doc, unnest(range(1, len(words) - 3)) as t(pos)
), again as (
    select row, pos from run qualify count(*) over (partition by row, run) > 1
), covered as (
    select row, count(distinct pos + k) as n from again, unnest(range(0, 5)) as t(k) group by row
), measured as (
    select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_upper,
           len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(n, 0) as n_repeat_words
    from doc left join covered using (row)
)
select doc_id, n_words, word_chars, n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       n_repeat_words, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 100 * n_symbols > 25 * n_words
            or 100 * n_upper > 50 * word_chars or 100 * n_dup_lines > 50 * n_lines
            or word_chars > 40 * n_words) as kept
from measured
"""

QUERIES = (
    Query("op1_toxicity", op1_toxicity),
    Query("op2_packing", op2_packing),
    Query("op3_embedding_dedup", op3_embedding_dedup, SQL3),
    Query("op4_ngram_join", op4_ngram_join, SQL4),
    Query("op5_quality", op5_quality),
    Query("op6_substring_dedup", op6_substring_dedup, SQL6),
    Query("op7_chat", op7_chat),
    Query("op8_warc", op8_warc, SQL8),
    Query("op9_decontamination", op9_decontamination, SQL9),
    Query("op10_token_counts", op10_token_counts),
    Query("op11_tokenizer_alignment", op11_tokenizer_alignment),
    Query("op12_prefix_trie", op12_prefix_trie, SQL12),
    Query("op13_quality_rules", op13_quality_rules, SQL13),
    Query("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
)

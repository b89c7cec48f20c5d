"""One query for each operator, with the digests that its contract asks for, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlake.llm import decontaminate, language, licenses, lines, piece_codec, prefix_trie, shards, shingles, suffixes, token_files, topk, toxicity, vector_codes
from rotorlake.session import shared_folder

#: End id of the token files.
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training(doc_id: Column) -> Column:
    return ~held_out(doc_id)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), training)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.scores(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes by word shingles."""
    return shingles.classes(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document."""
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return language.identify(table(spark, sf_dir, "documents"), training(F.col("doc_id")), vocabulary)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs, lines and sentences that an earlier document or place holds, removed."""
    found = lines.dedup(table(spark, sf_dir, "documents"), with_kept=False, whole=True)
    return found.drop("text_hash").withColumn("spans", F.array_join(F.col("spans").cast("array<string>"), ","))


def topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors by integer inner product of every twentieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and benchmark items that each document shares in windows of ten words."""
    found = decontaminate.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of each document."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that strings of fifty bytes of earlier documents cover, removed."""
    return suffixes.dedup(table(spark, sf_dir, "documents"), with_kept=False).drop("spans")


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in bit-packed files and read back."""
    path = shared_folder(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer, END_ID)
    return token_files.read(spark, path).drop("ids")


def sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each document and the text decoded from them."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.encode(table(spark, sf_dir, "documents"), model, with_ids=False)


def vector_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, with the errors that they make."""
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(coded)
    return rows.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    turns = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns)).drop("id")


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document; the numbers of rows of two shards differ by one at most."""
    rows = shards.assign(table(spark, sf_dir, "documents"))
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown, F.col("home").alias("home_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity_scores,
    "op2_jaccard_join": jaccard_classes,
    "op3_topk_search": topk_search,
    "op4_decontaminate": decontaminated,
    "op5_language_id": language_id,
    "op6_license_scan": license_scan,
    "op7_line_dedup": line_dedup,
    "op8_suffix_dedup": suffix_dedup,
    "op9_token_files": token_files_query,
    "op10_sentencepiece": sentencepiece_codec,
    "op11_vector_codes": vector_codes_query,
    "op12_conversation_trie": conversation_trie,
    "op13_ring_shards": sharding,
}

TOPK_SQL = """
with v as (
  select vec_id, [floor(64 * x::double) for x in embedding] as e from embeddings
  where vec_id is not null
    and len([x for x in embedding if x is null or not isfinite(x::double)]) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""



def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every part against every entry of its codebook, a pair of steps a round; whole numbers below 2^53 throughout."""
    distance = "list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, b.x) + list_dot_product(b.x, b.x)"
    steps = [
        f"""v as materialized (
  select row_number() over (order by vec_id) as rid, vec_id, label, [floor(1024 * x::double) for x in embedding] as e from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x::double)]) = 0
), p as materialized (
  select rid, part, list_slice(e, part * (len(e) // {parts}) + 1, (part + 1) * (len(e) // {parts})) as x
  from v, (select unnest(range({parts})) as part)
), b0 as materialized (select part, rid - 1 as entry, x from p where rid <= {entries})"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} as materialized (
  select rid, part, min({{'d': d, 'entry': entry}}) as best
  from (select p.rid, p.part, b.entry, {distance} as d from p join b{r} b on p.part = b.part) group by rid, part
)"""
        )
        if r < rounds:
            steps.append(
                f"""u{r} as materialized (
  select part, entry, list(floor(total / n) order by side) as x from (
    select part, entry, side, sum(value) as total, count(*) as n from (
      select p.part, a.best.entry as entry, unnest(p.x) as value, unnest(range(len(p.x))) as side
      from p join a{r} a on p.part = a.part and p.rid = a.rid
    ) group by part, entry, side
  ) group by part, entry
), b{r + 1} as materialized (
  select b.part, b.entry, coalesce(u.x, b.x) as x from b{r} b left join u{r} u on b.part = u.part and b.entry = u.entry
)"""
            )
    steps.append(
        f"""books as (
  select sha256(string_agg(value::bigint::varchar, ',' order by part, entry, side)) as h
  from (select part, entry, unnest(x) as value, unnest(range(len(x))) as side from b{rounds})
), c as (
  select rid, string_agg(printf('%02x', best.entry), '' order by part) as code, sum(best.d)::bigint as error from a{rounds} group by rid
)"""
    )
    return f"""with {", ".join(steps)}
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, h as codebooks_sha256
from v join c using (rid), books"""


#: CRC-32 of the decimal digits of c, a bit at a time.
CRC32_SQL = """xor(4294967295, list_reduce(
  list_concat([4294967295::bigint], [ord(x)::bigint for x in string_split(c::varchar, '')]),
  lambda a, b: list_reduce(
    [xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: case when y % 2 = 1 then xor(y >> 1, 3988292384) else y >> 1 end
  )
))"""

TRIE_SQL = f"""
with t as (
  select conv_id as c, turn, coalesce(text, '') as text,
    left(sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 32) as dig
  from conversations where conv_id is not null
), own as materialized (
  select c, list({{'dig': dig, 'n': strlen(text)}} order by turn nulls first, dig) as l, {CRC32_SQL} % 9 as h from t group by c
), q as materialized (
  select o.c, list_concat(coalesce(list_slice(b.l, 1, o.h), []), list_slice(o.l, o.h + 1, len(o.l))) as l
  from own o left join own b on b.c = o.c - o.c % 5
), m as (
  select c, d, list_slice(l, 1, d) as p, d = len(l) as final from (select c, l, unnest(range(len(l) + 1)) as d from q)
), node as materialized (
  select p, d, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * coalesce(p[d].n, 0) as saved,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (final), '')) as ends_sha256
  from m group by p, d
), kids as (
  select list_slice(p, 1, d - 1) as p, count(*) as n from node where d > 0 group by 1
), whole as materialized (
  select node.*, coalesce(kids.n, 0) as n_children from node left join kids on node.p = kids.p
), sums as (
  select a.p, count(*) filter (b.n_children = 0) as n_leaves, sum(b.saved) as saved_tokens
  from whole a join whole b on b.d >= a.d and list_slice(b.p, 1, a.d) = a.p group by a.p
)
select w.conv_id, w.d as depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, w.ends_sha256
from whole w join sums s on w.p = s.p left join whole u on u.d = w.d - 1 and list_slice(w.p, 1, w.d - 1) = u.p
"""

#: Two documents with an n-gram in common meet by it; links are closed by walking them.
JACCARD_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from (select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents)
), s as materialized (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(list_slice(w, i, i + 4), ' ') for i in range(1, len(w) - 3)]) end as s
  from w
), g as materialized (
  select doc_id, len(s) as n, unnest(s) as g from s
), links as materialized (
  select a.doc_id as a, b.doc_id as b from g a join g b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a
)
select doc_id, cast(len(s) as bigint) as n_shingles, least(doc_id, min(b)) as component_id from s join reach on doc_id = a group by doc_id, s
"""

#: Windows of the items, of ten words or of a whole shorter item, met by all windows of these lengths of the documents.
WINDOWS_SQL = r"""
with t as (
  select 'doc' as kind, doc_id as id, text from documents union all select 'item', item_id, text from benchmark
), w as materialized (
  select kind, id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from t
), item as materialized (
  select distinct id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as s
  from (select id, w, least(10, len(w)) as k, unnest(range(1, greatest(len(w) - 8, 2))) as i from w where kind = 'item' and len(w) > 0)
), hit as materialized (
  select d.id, d.i, d.k, item.id as item_id
  from (select id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') as s
        from (select id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) as i from w, (select distinct k from item) where kind = 'doc')) d
  join item on d.s = item.s and d.k = item.k
), words as (
  select id, count(*) as n from (select distinct id, unnest(range(i, i + k)) as place from hit) group by id
), items as (
  select id, count(*) as n, string_agg(name, ',' order by name) as names
  from (select distinct id, item_id::varchar as name from hit) group by id
)
select w.id as doc_id, cast(len(w.w) as bigint) as n_words, coalesce(words.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
  sha256(coalesce(items.names, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from w left join words on w.id = words.id left join items on w.id = items.id where w.kind = 'doc'
"""

SQL: dict[str, str] = {
    "op2_jaccard_join": JACCARD_SQL,
    "op4_decontaminate": WINDOWS_SQL,
    "op3_topk_search": TOPK_SQL,
    "op11_vector_codes": _codes_sql(),
    "op12_conversation_trie": TRIE_SQL,
}

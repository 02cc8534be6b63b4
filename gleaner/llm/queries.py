"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (
    byte_shards, chat_format, chat_repair, filter_audit, line_dedup, permutation_index, piece_codec, secret_scan,
    simhash_dedup, source_mix, token_counts, toxicity, vectors,
)
from gleaner.llm.shared import settled
from gleaner.session import apply_settings

PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"
#: The separator of the byte-level vocabulary: the id after its last.
SEPARATOR = 50256


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rows = piece_codec.encode(docs, public_tokenizers.path(PIECES))
    return rows.select(
        "doc_id", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("starts", "ends"), 256).alias("spans_sha256"))


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.exact_top_k(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.without_repeats(_table(spark, folder, "documents").select("doc_id", "text"))


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = source_mix.with_copies(_table(spark, folder, "documents"), [])
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rows = toxicity.scored(docs, toxicity.fit(docs, _table(spark, folder, "labels")))
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    rows = secret_scan.scan(_table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    by_start = F.array_sort(F.concat("base", "added"), lambda a, b: F.when(
        a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    return rows.select(
        "doc_id", *[count(kind) for kind, *_ in secret_scan.BASE],
        F.sha2(secret_scan.joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.when(F.size("added") > 0, by_start).otherwise(F.col("base"))).alias("spans"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    blocks, manifest = token_counts.write_flat(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, SEPARATOR)
    counted = token_counts.documents_of(blocks, SEPARATOR)
    return manifest.join(counted, ["file", "ordinal"]).select(F.col("id").alias("doc_id"), "n_tokens")


def op9_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    awkward = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)],
                                 "conv_id long, turn long, role string, text string")
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    rows = chat_format.formatted(turns)
    back = rows.select("conv_id", F.col("formatted"), chat_format.read_back(F.col("formatted")).alias("turns"),
                       chat_format.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    cells = filter_audit.cells(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return filter_audit.interactions(cells)


def op12_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = byte_shards.shard_list(_table(spark, folder, "documents"))
    return rows.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op13_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations")
    turns = chat_repair.damaged(given)
    audits = settled(chat_repair.audited(turns))
    rows = audits.join(chat_repair.digests(turns, audits).withColumnRenamed("conv_id", "c"),
                       F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    every = given.select(F.col("conv_id").alias("c")).distinct()
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(rows, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        F.col("c").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(apply_settings(spark), folder)


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as q from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id as vec_id, list_inner_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""

OP4_SQL = """
with d as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
w as (
  select doc_id, i as pos, ls[i + 1 : i + 3] as win from d, unnest(range(0, len(ls) - 2)) as t(i)
  where not (trim(ls[i + 1]) = '' and trim(ls[i + 2]) = '' and trim(ls[i + 3]) = '')),
k as (select doc_id, pos, row_number() over (partition by win order by doc_id, pos) as nth from w),
cut as (select distinct doc_id, pos + j as pos from k, unnest([0, 1, 2]) as t(j) where nth > 1),
lines as (select doc_id, i as pos, ls[i + 1] as line from d, unnest(range(0, len(ls))) as t(i)),
kept as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.pos) as text from lines l
  left join cut c on l.doc_id = c.doc_id and l.pos = c.pos where c.pos is null group by l.doc_id),
cuts as (select doc_id, count(*) as lines_cut from cut group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(kept.text, '') end as text,
  coalesce(len(d.ls), 0)::bigint as lines, coalesce(lines_cut, 0)::bigint as lines_cut
from d left join kept using (doc_id) left join cuts using (doc_id)
"""

OP5_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, ([5.0, 2.0, 1.0])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight,
    2.0::double * source_size as cap from s),
l as (
  select *, row_number() over before_all as nth, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over before, 0))
      / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
  from w window before as (
    order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding),
    before_all as (order by cap / weight, source nulls last)),
t as (
  select source, source_size,
    least(cap, coalesce(arg_min(case when level <= cap / weight then level end, nth) over (), 'inf'::double) * weight) as target
  from l),
p as (
  select d.*, row_number() over (partition by source order by size, doc_id % 64, doc_id) as place from d),
j as (
  select p.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    ('0x' || substr(md5('mix' || coalesce(':' || p.source, '')), 1, 8))::bigint::double / 4294967296 as start
  from p join t on p.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (size * (floor(start + rate * place) - floor(start + rate * (place - 1))))::bigint as taken
from j
"""

OP10_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) as prev,
    replace(replace(text, '\', '\b'), '<', '\l') as body, replace(replace(role, '\', '\b'), '<', '\l') as name from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), ''))
    as loss_sha256,
  sum(length(body) + case when prev = role then 5 else 6 + length(name) + 6 + 8 end)::bigint as formatted_chars
from o group by conv_id
"""

OP11_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    coalesce(doc_id > min(doc_id) over (partition by coalesce(text, '')), false) as copied from documents),
m as (
  select doc_id, part, (len(words) < 50)::int + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
    + 4 * (100 * len(regexp_extract_all(body, '[A-Z]')) > 5 * length(body))::int
    + 8 * regexp_matches(body, '[#$%&*|]')::int + 16 * copied::int as mask from d),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
c as (
  select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
  from m left join l using (doc_id) group by part, mask),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as t(x, bit)),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e where a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (
  select filter_order, i::int as step, bits[i] as bit, list_sum(list_concat([0], bits[1:i - 1]))::int as earlier
  from o, unnest(range(1, 6)) as t(i)),
r as (
  select part, filter_order, step, bit,
    sum(case when mask & (earlier | bit) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & earlier = 0 and mask & bit > 0 then n else 0 end)::bigint as removed,
    sum(case when mask & earlier > 0 and mask & bit > 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when mask & earlier = 0 and mask & bit > 0 then good else 0 end)::bigint as good_lost,
    sum(case when mask & earlier = 0 and mask & bit > 0 then toxic else 0 end)::bigint as toxic_lost
  from s, c group by part, filter_order, step, bit)
select * exclude (bit), sum(removed) over (partition by part, bit)::bigint as shapley from r
"""

OP12_SQL = """
with k as (
  select list(list_reduce(list_concat([i], range(8)), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384)
    else c >> 1 end) order by i) as t from (select unnest(range(256))::bigint as i)),
d as (
  select doc_id, coalesce(strlen(text), 0)::bigint + 1 as size, xor(4294967295, list_reduce(
      list_concat([4294967295::bigint], list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint)),
      lambda c, x: xor(c >> 8, k.t[(xor(c, x) & 255) + 1])))::bigint as text_crc32,
    md5(coalesce(text, '')) as a, substr(md5(coalesce(doc_id::varchar, '')), 1, 16) as b, row_number() over () as nth
  from documents, k),
o as (
  select *, row_number() over w - 1 as pos, (sum(size) over w)::bigint as upto, (sum(size) over ())::bigint as total
  from d window w as (order by a, b, nth)),
g as (
  select a, min(upto - size) as lo, max(upto) as hi, min(pos) as first, max(pos) + 1 as behind, any_value(total) as total
  from o group by a),
s as (select i as s from unnest(range(1, 8)) as t(i)),
ends as (
  select s, 8 * lo as lo, 8 * hi as hi, s * total as place, first, behind, a, total,
    100 * least(s * total - 8 * lo, 8 * hi - s * total) <= total as near
  from s join g on 8 * lo <= s * total and s * total < 8 * hi),
cut as (
  select s, case when place - lo <= hi - place then first else behind end as cut from ends where near
  union all
  select s, case when e.place - 8 * (upto - size) <= 8 * upto - e.place then pos else pos + 1 end
  from ends e join o on e.a = o.a and 8 * (upto - size) <= e.place and e.place < 8 * upto where not near),
p as (select o.*, (select count(*) from cut where cut <= o.pos)::int as shard from o)
select doc_id, size, text_crc32, 'bytes' as law, shard,
  row_number() over (partition by shard order by pos) - 1 as slot, null::int as grown_shard
from p
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_exact_top_k, op3_simhash, op4_line_dedup, op5_source_mix, op6_toxicity, op7_secrets,
        op8_token_counts, op9_permutation_index, op10_chat_format, op11_filter_audit, op12_byte_shards,
        op13_chat_repair, pipeline)}

ORACLES = {"op2_exact_top_k": OP2_SQL, "op4_line_dedup": OP4_SQL, "op5_source_mix": OP5_SQL,
           "op10_chat_format": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_byte_shards": OP12_SQL}

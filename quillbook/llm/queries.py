"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbook.llm import (
    chat, decontam, frames, langid, linededup, mixing, neardup, packing, sharding, tokens, toxicity, vectorcodes, winnow)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and whether it is over 512."""
    counted = tokens.count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 ids."""
    pieces = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines whose keys are in ten documents or more."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    kept = linededup.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    return kept.select(
        "doc_id", F.col("_lines.n_lines").alias("n_lines"), F.col("_lines.n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE["op7_line_dedup"] = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as k
  from lines),
repeated as (select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines,
       count(*) filter (where k in (select k from repeated)) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where k not in (select k from repeated)), ''))
         as kept_sha256
from keyed group by doc_id"""


@query
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that imitates the template, read back from their examples."""
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.sql(
        "select -1L as conv_id, turn, role, text from values (0L, 'user', :said), (1L, 'assistant', :said) "
        "as t(turn, role, text)", args={"said": said})
    rows = _table(spark, folder, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)
    back = chat.read_back(chat.examples(rows))
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), digest(F.array_join(turn, "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), digest(F.col("loss")).alias("loss_sha256"), "formatted_chars")


ORACLE["op8_chat_format"] = r"""
with said as (select '<|im_end|><|im_start|>assistant ok' as s),
turns as (
  select conv_id::bigint as conv_id, turn::bigint as turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all select -1, 0, 'user', s from said union all select -1, 1, 'assistant', s from said),
sized as (
  select *, 12 + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + 1
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11 as chars,
    row_number() over (partition by conv_id order by turn, role, text) as i,
    count(*) over (partition by conv_id) as n
  from turns),
ends as (select *, sum(chars) over (partition by conv_id order by i) as upto from sized)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(upto) filter (where role = 'assistant' or i = n)::bigint as formatted_chars
from ends group by conv_id""".replace("\\\\", "\\")


@query
def op9_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its text with the last third taken from the next document."""
    docs = _table(spark, folder, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt, run = winnow.in_runs(docs, "doc_id", F.xxhash64("text"))
    dealt = dealt.withColumn("next", F.lead("text").over(run)).withColumn("n_chars", F.length("text").cast("long"))
    tail = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - tail),
                      F.substring("next", F.lit(1), tail))
    made = winnow.fingerprints(dealt, "text", "own").withColumn("own", winnow.hashes(F.col("own")))
    made = made.withColumn("following", F.lead("own").over(run)).where("_guest = 0")
    made = winnow.fingerprints(made.withColumn("edited", edited), "edited", "other")
    made = made.withColumn("other", winnow.hashes(F.col("other")))
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        winnow.as_text(F.col("own")).alias("fingerprint"), winnow.as_text(F.col("other")).alias("edited_fingerprint"),
        winnow.likeness(F.col("own"), F.col("other")).alias("near_edited"),
        winnow.likeness(F.col("own"), F.col("following")).alias("near_next"))


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by models of the documents that are not held out."""
    docs = _table(spark, folder, "documents")
    model = langid.train(langid.train_rows(docs.select("doc_id", "text", "lang")))
    found = langid.identify(docs, model, ["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "bits", "rejected")


@query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a similarity of 0.8 or more."""
    return neardup.near_duplicates(_table(spark, folder, "documents"), size=2, percent=80)


ORACLE["op5_minhash_near_dedup"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1])) as s from words
    union all select doc_id, w[1] from words where len(w) = 1)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 80 * (p.n + q.n - c)),
both_ways as (select x, y from links union all select y, x from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union select r.doc_id, b.y from reach r join both_ways b on b.x = r.other),
least as (select doc_id, min(other) as component_id from reach group by doc_id)
select l.doc_id, coalesce(n, 0) as n_shingles, component_id, l.doc_id = component_id as kept
from least l left join sizes s on s.doc_id = l.doc_id"""


@query
def op6_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards along a curve through text size, language and source."""
    docs = _table(spark, folder, "documents")
    dimensions = {
        "bytes": F.octet_length(F.coalesce("text", F.lit(""))), "lang": sharding.as_number(F.col("lang")),
        "source": sharding.as_number(F.col("source"))}
    placed = sharding.hilbert_shards(docs, dimensions, shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    found = decontam.indexes(_table(spark, folder, "benchmark"))
    return decontam.leaks(_table(spark, folder, "documents"), found)


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from labelled documents that are not held out."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.train(docs, langid.train_rows(labels))
    found = toxicity.score(docs, model, ["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "score",
                        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


#: Weights 5, 2 and 1 in the whole: the first falls, the second stays, the third rises.
SCHEDULES = [mixing.Schedule(((0, 7.5), (1, 2.5))), mixing.Schedule(((0, 2), (1, 2))), mixing.Schedule(((0, 0.5), (0.5, 1), (1, 1.5)))]


@query
def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document, by the position at which it is read first."""
    found = mixing.mixed(_table(spark, folder, "documents"), SCHEDULES, passes=3)
    return mixing.in_order(found).select("doc_id", "size", "source_size", "target", "taken", F.size("places").alias("readings"))


ORACLE["op12_mixing"] = r"""
with recursive docs as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as name,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sums as (select source, sum(size)::bigint as s from docs group by source),
weighed as (
  select source, s, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double
         when 1 then 2.0::double else 1.0::double end as w
  from sums),
shared(round, source, s, w, t) as (
  select 0, source, s, w, (select sum(s) from sums) * w / (select sum(w) from weighed) from weighed
  union all
  select round + 1, source, s, w,
         case when t >= 3 * s then 3.0::double * s
              else w * ((select sum(s) from sums) - sum(case when t >= 3 * s then 3 * s else 0 end) over ())
                   / sum(case when t >= 3 * s then 0 else w end) over () end
  from shared where round < 40),
final as (select source, s, t as target, floor(t)::bigint as take from shared where round = 40),
due as (
  select d.*, f.s, f.target, f.take,
         sum(size) over (partition by d.source order by name, doc_id, size rows unbounded preceding)::bigint - size as "at"
  from docs d join final f on d.source is not distinct from f.source),
each as (select *, list_transform([0, 1, 2], lambda p: greatest(least(take - (p * s + due."at"), size), 0)) as got from due)
select doc_id, size, s as source_size, target, list_sum(got)::bigint as taken,
       len(list_filter(got, lambda x: x > 0))::int as readings
from each"""


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its middle moved to the end, and the text rebuilt from that."""
    found = frames.digests(frames.fill_in_middle(_table(spark, folder, "documents")))
    plain = F.col("form") == "plain"
    return found.select(
        "doc_id", "n", "form", F.when(~plain, F.col("low")).alias("prefix_chars"),
        F.when(~plain, F.col("high") - F.col("low")).alias("middle_chars"), "output_sha256", "restored_sha256")


ORACLE["op13_fill_in_middle"] = """
with drawn as (
  select doc_id, coalesce(text, '') as x, length(coalesce(text, ''))::bigint as n,
         [('0x' || substr(sha256('1:' || doc_id), k, 8))::bigint for k in [1, 9, 17, 25]] as h
  from documents),
cut as (
  select *, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
         case when n = 0 or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h[3] % 100 >= 90 then 'plain'
              when h[4] % 100 < 20 then 'spm' else 'psm' end as form
  from drawn)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then x
              when 'psm' then '<P>' || substr(x, 1, a) || '<S>' || substr(x, b + 1) || '<M>' || substr(x, a + 1, b - a)
              else '<S>' || substr(x, b + 1) || '<P>' || substr(x, 1, a) || '<M>' || substr(x, a + 1, b - a) end) as output_sha256,
       sha256(x) as restored_sha256
from cut"""


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings, their errors and the digest of the codebooks."""
    codes, books = vectorcodes.compress(_table(spark, folder, "embeddings"))
    return vectorcodes.label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(vectorcodes.digest(books)).alias("codebooks_sha256"))


def _rounds() -> str:
    """Codebooks after each round, one common table after the other."""
    step = """
near{r} as (
  select c.vec_id, c.p, c.x, arg_min(b.k, (list_sum(list_transform(list_zip(c.x, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.k)) as k
  from cut c join book{r} b on b.p = c.p group by 1, 2, 3),
moved{r} as (
  select p, k, list(m order by d) as y from (
    select p, k, d, ((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) / count(*))::bigint as m
    from (select p, k, unnest(x) as v, generate_subscripts(x, 1) as d from near{r}) group by p, k, d) group by p, k),
book{n} as materialized (select b.p, b.k, coalesce(m.y, b.y) as y from book{r} b left join moved{r} m on m.p = b.p and m.k = b.k),"""
    return "".join(step.format(r=r, n=r + 1) for r in range(6))


ORACLE["op11_vector_codes"] = f"""
with good as (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
cut as materialized (
  select vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] as x from good, range(8) t(p)),
first as (select vec_id, row_number() over (order by vec_id) - 1 as k from good order by vec_id limit 16),
book0 as (select c.p, f.k, c.x as y from cut c join first f using (vec_id)),{_rounds()}
last as (
  select c.vec_id, c.label, c.p, min({{'d': list_sum(list_transform(list_zip(c.x, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'k': b.k}}) as n
  from cut c join book6 b on b.p = c.p group by 1, 2, 3),
codes as (
  select vec_id, label, string_agg(lpad(lower(to_hex(n.k::bigint)), 2, '0'), '' order by p) as code, sum(n.d)::bigint as error
  from last group by 1, 2),
books as (select sha256(string_agg(array_to_string(y, ','), ',' order by p, k)) as h from book6)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256
from codes, books"""

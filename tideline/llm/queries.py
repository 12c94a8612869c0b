"""Registered queries of the operators: whole tables, production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from tideline.llm import bpe, chat, codes, embeddings, html, language, mixing, phrases, quality_model, rules, simhash, toxicity, warc
from tideline.llm.common import fold, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in given.schema])
    planted = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    done = chat.formatted(given.unionByName(spark.createDataFrame(planted, schema)))
    read = done.select(
        "conv_id", "valid", "broken_at", "segments", chat.full_text(F.col("segments")).alias("formatted")
    ).withColumn("turns", chat.turns_of(F.col("formatted")))
    told = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = chat.learned_text(F.col("segments"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.col("broken_at").cast("long").alias("broken_at"),
    )


def _escaped_sql(column: str, role: bool = False) -> str:
    out = f"replace(replace({column}, '\\', '\\\\'), '<|', '<\\|')"
    return f"replace({out}, chr(10), '\\' || chr(10))" if role else out


_MOVES = ", ".join(f"({before!r}, {role!r})" for before, roles in chat.CHATML.moves.items() for role in roles)
_FINAL = ", ".join(map(repr, chat.CHATML.final))
OP3_SQL = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{CONTROL_TEXT}' union all select -1, 1, 'assistant', '{CONTROL_TEXT}'),
o as (select conv_id, role, row_number() over w as place, coalesce(lag(role) over w, 'start') as before,
    row_number() over w = count(*) over (partition by conv_id) as is_last
  from c window w as (partition by conv_id order by turn nulls first, role, text)),
m(before, role) as (values {_MOVES}),
b as (select conv_id, min(case when m.role is null then place when is_last and o.role not in ({_FINAL}) then place + 1 end) as broken_at
  from o left join m using (before, role) group by conv_id)
select * exclude (id) from (select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length('<|im_start|>' || {_escaped_sql("role", True)} || chr(10) || {_escaped_sql("text")} || '<|im_end|>' || chr(10)))::bigint
    as formatted_chars
from c group by conv_id) t join (select conv_id as id, broken_at is null as valid, broken_at from b) on id is not distinct from conv_id"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed(docs, corpus_pipeline.WEIGHTS, seed=corpus_pipeline.SEED).drop("order_key")


def _weights_sql() -> str:
    rows = ", ".join(f"({'null' if s is None else repr(s)}, {w!r}::double)" for s, w in corpus_pipeline.WEIGHTS.items())
    return f"select * from (values {rows}) as t(g, w)"


_NAMED = ", ".join(repr(s) for s in corpus_pipeline.WEIGHTS if s is not None)
OP4_SQL = f"""
with w as ({_weights_sql()}),
d as (select *, case when source in ({_NAMED}) then source end as g,
        'count|{corpus_pipeline.SEED}|' || coalesce(doc_id::varchar, 'null') as key from documents),
n as (select g, sum(coalesce(length(text), 0))::double as chars from d group by g),
r as (select w.g, (select sum(chars) from n) * w.w / sum(w.w) over () / n.chars as rate
      from w join n on w.g is not distinct from n.g where w.w > 0 and n.chars > 0),
s as (select g, rate / greatest(1, ceil(rate / {mixing.MOST_RATE})) as rate, greatest(1, ceil(rate / {mixing.MOST_RATE}))::bigint as parts from r),
e as (select *, ('0x' || substr(md5(key || case when part > 0 then '|' || part else '' end), 1, 13))::bigint / {1 << 52}::double as u
  from (select d.*, unnest(range(0, s.parts)) as part from d join s on s.g is not distinct from d.g)),
k as (select g, rate, unnest(range(0, (rate + 20 * sqrt(rate) + 60)::bigint)) as k from s),
p as (select g, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by g order by k) as upto from k),
c as (select doc_id, text, lang, source, n_chars, part,
        (select count(*) from p where p.g is not distinct from e.g and p.upto <= e.u and p.upto < 1) as n from e)
select doc_id, text, lang, source, n_chars, part * {mixing.PART_COPIES} + unnest(range(0, n)) as copy from c where n > 0"""


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) as (select vec_id, vec_id from v union select r.a, l.b from r join l on r.b = l.a),
c as (select a as vec_id, min(b) as component_id from r group by a),
n as (select a as vec_id, count(*) as n from l group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(c.component_id, e.vec_id) as component_id,
  e.vec_id = coalesce(c.component_id, e.vec_id) as kept
from embeddings e left join c using (vec_id) left join n using (vec_id)"""


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"), PIECE_BPE, BYTE_BPE)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = f"""
with p as (select page_id, coalesce(html, '') as h, strlen(coalesce(html, ''))::bigint as payload_bytes from pages),
f as (select *, sha256(h) as payload_digest, min(page_id) over (partition by h) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= {warc.LEAST_BYTES} and first is distinct from page_id and first is not null
    then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= {warc.LEAST_BYTES} and first is distinct from page_id then first end as refers_to
from f"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, fold(F.col("doc_id")) != 0)
    done = language.predict(docs, model, ["doc_id"])
    return done.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encoded(table(spark, sf_dir, "embeddings"))


def _lloyd_sql(rounds: int = codes.ROUNDS, entries: int = codes.ENTRIES, parts: int = codes.PARTS) -> str:
    """One block of common tables per round; ``c0`` has the first codebooks, ``cK`` those after round K."""
    out = [f"""with recursive v as materialized (
  select row_number() over () as id, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::double)::bigint) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select id, k as part, e[k * len(e) // {parts} + 1 : (k + 1) * len(e) // {parts}] as x from v, range({parts}) as r(k)),
s as (select id, row_number() over (order by vec_id nulls last, e) - 1 as entry from v),
c0 as materialized (select part, entry, x as c from p join s using (id) where entry < {entries})"""]
    for k in range(rounds + 1):
        out.append(f"""a{k} as materialized (select id, p.part, min(struct_pack(
    d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, entry := entry)) as best
  from p join c{k} using (part) group by id, p.part)""")
        if k < rounds:
            out.append(f"""m{k} as (select part, best.entry as entry, place,
    sum(x[place])::hugeint as total, count(*) as n
  from a{k} join p using (id, part), range(1, 1000) as r(place) where place <= len(x) group by all),
c{k + 1} as materialized (select part, entry, coalesce(list(((total - ((total % n) + n) % n) // n)::bigint order by place) filter (where n is not null), any_value(c)) as c
  from c{k} left join m{k} using (part, entry) group by part, entry)""")
    out.append(f"""h as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from c{rounds}),
r as (select id, string_agg(lpad(to_hex(best.entry), 2, '0'), '' order by part) as code, sum(best.d)::bigint as error from a{rounds} group by id)""")
    tail = """select vec_id, lower(code) as code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from r join v using (id), h"""
    return ",\n".join(out) + "\n" + tail


OP11_SQL = _lloyd_sql()


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
with d as (select coalesce(lang, '{phrases.NO_LANG}') as lang, row_number() over () as id,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as pieces
  from documents),
p as (select lang, row_number() over () as id, piece from (select lang, unnest(pieces) as piece from d)),
w as (select lang, id, unnest(l) as w1, generate_subscripts(l, 1) as pos
  from (select lang, id, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') as l from p)),
x as materialized (select lang, w1, lead(w1) over o as w2, lead(w1, 2) over o as w3 from w window o as (partition by id order by pos)),
g as (select lang, 1 as words, w1 as phrase from x union all select lang, 2, w1 || ' ' || w2 from x where w2 is not null
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from x where w3 is not null),
f as materialized (select lang, words, phrase, count(*) as n from g group by all),
t as (select lang, sum(n)::bigint as n from f where words = 1 group by lang),
q as materialized (select lang, words, phrase, n as a from f where words > 1 and n >= {phrases.SUPPORT}),
c as materialized (select q.*, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') as head,
    array_to_string(string_split(phrase, ' ')[k + 1 : words], ' ') as tail
  from q, range(1, {phrases.LONGEST}) as r(k) where k < words),
b as (select c.lang, c.phrase, c.words, a, arg_min(struct_pack(l := l.n, r := r.n, score := (1000000::hugeint * a * a // (l.n::hugeint * r.n))::bigint),
      struct_pack(s := (1000000::hugeint * a * a // (l.n::hugeint * r.n)), k := k)) as cut
  from c join f l on l.lang = c.lang and l.phrase = c.head join f r on r.lang = c.lang and r.phrase = c.tail
  group by all),
i as (select lang, array_to_string(string_split(phrase, ' ')[s : s + 1], ' ') as phrase, max(a) as around
  from q, range(1, 3) as r(s) where words = 3 group by all),
k as (select b.* from b left join i using (lang, phrase) where around is null or 100 * around < 50 * b.a),
o as (select lang, row_number() over (partition by lang order by cut.score desc, a desc, phrase) as rank, phrase, a, cut.l as l, cut.r as r, cut.score as score
  from k)
select lang, rank, phrase, a, l, r, t.n as n, score from o join t using (lang) where rank <= {phrases.TOP}"""


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_html_extraction, op2_quality_classifier, op3_chat_formatting, op4_mixing, op5_bpe, op6_simhash,
        op7_embeddings, op8_quality_rules, op9_warc, op10_language_id, op11_vector_codes, op12_phrases, op13_toxicity,
        pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op3_chat_formatting": OP3_SQL,
    "op4_mixing": OP4_SQL,
    "op7_embeddings": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_phrases": OP12_SQL,
}

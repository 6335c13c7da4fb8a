"""The registered queries of this package and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    conversation_repair,
    exact_dedup,
    html_diff,
    line_dedup,
    lm_score,
    near_dup,
    packing,
    pareto_mix,
    pii,
    spelling,
    topk,
    toxicity,
    url_filter,
)
from eventmart.llm.common import fold, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# A-Z alone lower-cased, in SQL.
AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op2_harmonic_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query(
    "op3_pareto_mix",
    r"""
    with recursive rows as (
      select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
             (cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 0.5::double)
               / 4503599627370496.0::double as u
      from documents),
    sums as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
    ranked as (
      select *, row_number() over (order by source nulls last) - 1 as nth, 2.0::double * source_size as most from sums),
    weighted as (
      select *, (case nth % 3 when 0 then 3 when 1 then 1 else 2 end)::double as weight from ranked),
    levels as (select *, most / weight as level, 1.5::double * (sum(source_size) over ())::double as budget from weighted),
    tried as (
      select *, (budget - coalesce(sum(most) over (order by level, nth rows between unbounded preceding and 1 preceding), 0))
             / sum(weight) over (order by level, nth rows between current row and unbounded following) as try from levels),
    lvl as (select max(try) filter (where level > try) as l from tried),
    targets as (select source, source_size, least(most, coalesce(l * weight, most)) as target from tried, lvl),
    odds as (
      select r.*, t.source_size, t.target,
             case when t.source_size > 0 then least(2.0::double, target / t.source_size) else 0 end as expected
      from rows r join targets t on r.source is not distinct from t.source),
    parts as (select *, floor(expected) as sure, expected - floor(expected) as p from odds),
    lots as (
      select *, case when p > 0 and size > 0 then u / (1 - u) * (1 - p) / p end as lot,
             target - sum(sure * size) over (partition by source) as rest from parts),
    run as (
      select *, coalesce(sum(case when lot is not null then size end) over (
               partition by source order by lot nulls last, size, doc_id rows between unbounded preceding and 1 preceding), 0) as before
      from lots)
    select doc_id, size, source_size, target,
           cast(size * (sure + case when lot is not null and (rest - before) * 2 >= size then 1 else 0 end) as bigint) as taken
    from run
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of one and a half times all words takes of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return pareto_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query(
    "op5_exact_dedup",
    f"""
    with rows as (select doc_id, {AZ.format("coalesce(text, '')")} as norm from documents)
    select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
           doc_id = max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
    from rows
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its exact copies that stays."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query(
    "op7_line_dedup",
    f"""
    with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    exploded as (select doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from split),
    keyed as (
      select doc_id, pos, line, {AZ.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key
      from exploded),
    shared as (
      select key, min(doc_id) as first_doc from keyed where length(key) >= 10
      group by key having count(distinct doc_id) >= 2),
    marked as (
      select k.doc_id, pos, line, s.key is not null and k.doc_id <> s.first_doc as gone
      from keyed k left join shared s on k.key = s.key)
    select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one has."""
    kept = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rule or model."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.url_filter(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


@query("op10_near_dup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies, on two-word shingles."""
    return near_dup.near_dup(table(spark, sf_dir, "documents"), width=2, percent=80)


@query(
    "op6_norm_bucket_topk",
    """
    with v as (
      select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    pairs as (
      select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
    ranked as (
      select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as place from pairs)
    select query_id, cast(place as integer) as rank, vec_id, score from ranked where place <= 5
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector over all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


@query("op1_url_difference")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    texts = html_diff.extract(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op8_deleted_interpolation")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document, by a model of six sevenths of them; fold 3 tunes the weights."""
    part = fold(F.col("doc_id"), 7)
    scored = lm_score.lm_scores(table(spark, sf_dir, "documents"), train=part != 2, tune=part == 3)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op4_string_kernel_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by a machine that learned from four fifths of the labels."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.train(docs, labels, learned=fold(F.col("doc_id"), 5) != 0)
    return toxicity.toxicity(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


# The CRC-32 of a list of bytes, as DuckDB has none: its table from the polynomial, then one step a byte.
CRC_TABLE = """
      select list(c order by i) as crc_table
      from (select i, list_reduce(range(8), lambda acc, k: case when acc & 1 = 1 then xor(acc >> 1, 3988292384) else acc >> 1 end, i) as c
            from range(256) as numbers(i))"""
CRC = "xor(list_reduce({0}, lambda acc, b: xor(acc >> 8, crc_table[(xor(acc, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"


def _after(state: str, cost: str, edits: str) -> str:
    """A state of the dynamic program, nine digits of cost and then the edits, with more of both."""
    return f"lpad(cast(cast(left({state}, 9) as bigint) + {cost} as varchar), 9, '0') || substr({state}, 10) || '{edits}'"


def _turned(state: str, initial: str) -> str:
    """From `state` to the role that comes next: by a changed role, or by keeping a row of that role."""
    return f"{_after(state, '1 + cut', 'R')}, case when initial = '{initial}' then {_after(state, 'cut', 'K')} end"


@query(
    "op12_grammar_repair",
    f"""
    with recursive crc as ({CRC_TABLE}),
    keyed as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
             list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
                            lambda c: ascii(c)::bigint) as codes
      from conversations),
    marked as (select * exclude (codes), {CRC.format("codes")} % 20 as fault from keyed, crc),
    hurt as (
      select m.conv_id, turn, case when fault = 4 then 'user' else role end as role,
             case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, copy
      from marked m, range(2) as copies(copy) where fault <> 0 and (copy = 0 or fault = 3)),
    placed as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos,
             right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as last, left(role, 1) as first
      from hurt),
    faulty as (
      select *, case when last = '' then 'blank'
                     when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
                     when last not in ('.', '!', '?') then 'truncated' else '' end as kind,
             lag(first) over (partition by conv_id order by pos) || first as pair
      from placed),
    symbols as (
      select conv_id, pos, role, text, kind in ('blank', 'duplicate') as gone, case when kind = 'truncated' then 5 else 0 end as cut,
             first as initial
      from faulty),
    sums as (
      select conv_id, max(pos) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
             count(*) filter (where kind = 'blank') as blank, count(*) filter (where kind = 'duplicate') as duplicate,
             count(*) filter (where kind = 'truncated') as truncated,
             count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
      from faulty group by conv_id),
    walk as (
      select conv_id, 0::bigint as pos, '000000000' as v0, null::varchar as v1, null::varchar as v2, null::varchar as v3 from sums
      union all
      select conv_id, pos,
             {_after("v0", "2", "D")},
             case when gone then {_after("v1", "2", "D")}
                  else least({_after("v1", "2", "D")}, case when initial = 's' then {_after("v0", "cut", "K")} end) end,
             case when gone then {_after("v2", "2", "D")}
                  else least({_after("v2", "2", "D")}, {_turned("v0", "u")}, {_turned("v1", "u")}, {_turned("v3", "u")}) end,
             case when gone then {_after("v3", "2", "D")}
                  else least({_after("v3", "2", "D")}, {_turned("v2", "a")}) end
      from (
        select s.*, v0, v1, least(v2, {_after("v0", "5", "I")}, {_after("v1", "5", "I")}, {_after("v3", "5", "I")}) as v2,
               least(v3, {_after("v2", "5", "I")}, {_after("v0", "10", "II")}, {_after("v1", "10", "II")}) as v3
        from walk w join symbols s on s.conv_id is not distinct from w.conv_id and s.pos = w.pos + 1)),
    ends as (
      select s.*, least(v0, {_after("v1", "10", "II")}, {_after("v2", "5", "I")}, v3) as v
      from walk w join sums s on s.conv_id is not distinct from w.conv_id and s.n = w.pos),
    edits as (
      select conv_id, i, substr(v, 9 + i, 1) as edit,
             count(*) filter (where substr(v, 9 + i, 1) <> 'I') over (partition by conv_id order by i) as pos
      from (select conv_id, v, unnest(range(1, length(v) - 8)) as i from ends)),
    made as (
      select e.conv_id, i, edit, s.role, s.text, s.initial, row_number() over (partition by e.conv_id order by i) as nth
      from edits e left join symbols s on s.conv_id is not distinct from e.conv_id and s.pos = e.pos where edit <> 'D'),
    roles as (
      select *, case when first_value(edit = 'K' and initial = 's') over (partition by conv_id order by i) then nth - 1 else nth end as place
      from made),
    texts as (
      select conv_id, string_agg(case when edit = 'K' then role when place % 2 = 1 then 'user' else 'assistant' end || ':' ||
                                 case when edit = 'I' then '' else text end, chr(10) order by i) as repaired
      from roles group by conv_id)
    select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cast(left(v, 9) as bigint), 0) as cost,
           coalesce(substr(v, 10), '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
    from (select distinct conv_id from conversations) c
      left join ends e on c.conv_id is not distinct from e.conv_id
      left join texts t on c.conv_id is not distinct from t.conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after the damage and its cheapest repair."""
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


@query(
    "op13_kd_spelling",
    f"""
    with recursive crc as ({CRC_TABLE}),
    runs as (
      select coalesce(cast(doc_id as varchar), '') as doc,
             unnest(regexp_extract_all({AZ.format("coalesce(text, '')")}, '[a-z\u00c0-\u00ff]+')) as run
      from documents),
    keyed as (
      select run, list_transform(regexp_extract_all(hex(encode(doc || ':' || run)), '..'), lambda b: cast('0x' || b as bigint)) as codes
      from runs where length(run) >= 6),
    hashed as (select run, {CRC.format("codes")} as h from keyed, crc),
    kept as (
      select case when h % 199 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed),
    words as (select word, count(*) as n from kept where length(word) >= 6 group by word having count(*) >= 5),
    less as (
      select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
      from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
    pairs as (
      select a.word, a.n, b.word as near, b.n as near_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
      union select l.word, l.n, w.word, w.n from less l join words w on w.word = l.rest
      union select w.word, w.n, l.word, l.n from less l join words w on w.word = l.rest),
    best as (
      select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from pairs group by word),
    formed as (
      select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * w.n then near end as form,
             case when near_n >= 5 * w.n then near_n end as form_n
      from words w left join best b on w.word = b.word),
    follow as (
      select word, word as root, form as next from formed
      union all select f.word, f.next, g.form from follow f join formed g on g.word = f.next),
    ended as (select word, root from follow where next is null)
    select f.word, form, root, n, n_near, form_n from formed f join ended e on f.word = e.word
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its form, a near word at least five times as frequent, and its root."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op11_skip_chain_pii")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: the patterns' spans and those that the field adds."""
    docs = table(spark, sf_dir, "documents")
    return pii.personal_data(docs, pii.train(docs))

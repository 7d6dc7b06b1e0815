"""The operators' queries over the driver's tables, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, html_graph, kd_search, license_scan, line_dedup, merkle, mixing, near_dup, perplexity, token_files, toxicity, url_rules, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxicity.score(docs, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def tokenizer_path() -> str:
    """The vocabulary file of the tokenizer queries (an installed public package)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every query vector."""
    return kd_search.search(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity verdict of every document."""
    return perplexity.judge(_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode(docs, tokenizer_path(), decode=True)
    n_tokens = (F.octet_length("token_ids") / 4).cast("long")
    return out.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = html_graph.extract(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document's ids lie in the written token files, and their checksum as read back."""
    docs = _table(spark, sf_dir, "documents")
    root = token_files.new_root(spark)
    return token_files.read(token_files.write(docs, tokenizer_path(), root), root, docs.schema["doc_id"].dataType.simpleString())


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, winning rule and verdict of every page's url."""
    return url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), url_rules.rule_table(spark))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines that an earlier line equals or nearly equals."""
    return line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document, and whether it is the one that stays."""
    out = near_dup.classes(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    rows = mixed.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's whitened components."""
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof digest, and whether it verifies after a fifth of the texts were tampered with."""
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    now = merkle.leaf(docs, F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text")))
    return merkle.build(docs, now=now).check("now")


def queries() -> dict:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_top_k": op2_top_k,
        "op3_quality_rules": op3_quality_rules,
        "op4_bpe": op4_bpe,
        "op5_page_text": op5_page_text,
        "op6_token_files": op6_token_files,
        "op7_url_rules": op7_url_rules,
        "op8_line_dedup": op8_line_dedup,
        "op9_near_dup": op9_near_dup,
        "op10_mix_sources": op10_mix_sources,
        "op11_license_scan": op11_license_scan,
        "op12_whitening": op12_whitening,
        "op13_merkle": op13_merkle,
    }


def _rule_values() -> str:
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES)


#: Levels of the Merkle SQL: enough for 16 ** 5 documents a source and 16 ** 4 sources.
_LOWER, _UPPER = 5, 4


def _merkle_sql() -> str:
    """One CTE a level; a run's members and a node's place are window ranks, and trees that have one node left stay as they are."""

    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    def lift(prefix: str, group: str, levels: int) -> str:
        out = []
        for k in range(levels):
            out.append(f"""
{prefix}{k + 1} as materialized (
  select {group}, case when any_value(n) = 1 then 0 else i // 16 end as i, case when any_value(n) = 1 then 1 else (any_value(n) + 15) // 16 end as n,
         case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by i)) end as h
  from {prefix}{k} group by {group}, i // 16, case when n = 1 then i end
)""")
        return ",".join(out)

    def climb(prefix: str, group: str, start: int, levels: int) -> str:
        """Joins each climbing row with the other members of its run, level by level."""
        out = []
        for k in range(levels):
            a, b = f"c{start + k}", f"c{start + k + 1}"
            out.append(f"""
{b} as materialized (
  select x.id, x.{group}, x.i // 16 as i, any_value(x.leaf) as leaf, any_value(x.sib) || coalesce(string_agg(t.h, '' order by t.i) filter (t.i <> x.i), '') as sib,
         case when any_value(t.n) = 1 then any_value(x.now)
              else sha256(coalesce(string_agg(t.h, '' order by t.i) filter (t.i < x.i), '') || any_value(x.now) || coalesce(string_agg(t.h, '' order by t.i) filter (t.i > x.i), '')) end as now
  from {a} x join {prefix}{k} t on x.{group} = t.{group} and x.i // 16 = t.i // 16 group by x.id, x.{group}, x.i
)""")
        return ",".join(out)

    changed = "case when crc % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    return f"""
with bits as (
  select row_number() over () as id, *, flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0])) as s from documents
), crcs as (
  select * exclude (s), xor(list_reduce(list_prepend(4294967295::bigint, cast(s as bigint[])), lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) as crc from bits
), hashed as materialized (
  select id, doc_id, coalesce('=' || source, '-') as grp, sha256({head} || {field("text")}) as leaf, sha256({head} || {field(changed)}) as now from crcs
), ranked as materialized (
  select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by grp) as n from hashed
), a0 as materialized (select grp, i, n, leaf as h from ranked),
{lift("a", "grp", _LOWER)},
b0 as materialized (select 0 as top, grp, row_number() over (order by encode(grp)) - 1 as i, count(*) over () as n, h from a{_LOWER}),
{lift("b", "top", _UPPER)},
c0 as (select id, grp, i, leaf, '' as sib, now from ranked),
{climb("a", "grp", 0, _LOWER)},
c{_LOWER + 1} as (select c.id, b0.top, b0.i, c.leaf, c.sib, c.now from c{_LOWER} c join b0 using (grp)),
{climb("b", "top", _LOWER + 1, _UPPER)}
select r.doc_id, r.leaf, b0.h as subroot, t.h as root, sha256(c.sib) as proof_sha256, c.now as folded_root, c.now = t.h as verified
from c{_LOWER + 1 + _UPPER} c join ranked r using (id) join b0 on b0.grp = r.grp cross join b{_UPPER} t
"""


def _template_values() -> str:
    return ", ".join(f"({i}, '{t.label}', {str(t.is_phrase).lower()}, '{' '.join(t.words)}')" for i, t in enumerate(license_scan.templates()))


def oracle_sql() -> dict[str, str]:
    return {
        "op11_license_scan": f"""
with template(template, label, is_phrase, body) as (values {_template_values()}),
tword as (
  select template, label, is_phrase, string_split(body, ' ') as w from template
), trun as materialized (
  select template, label, is_phrase, len(w) as m, unnest(range(len(w) - 2)) as t, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) as run from tword
), word as materialized (
  select row_number() over () as id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), run as (
  select id, unnest(range(greatest(len(w) - 2, 0))) as p, unnest(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i:i + 2])) as run from word
), cell as materialized (
  select distinct id, template, p - t as d, t + unnest([0, 1, 2]) as place from run join trun using (run)
), kind as (select distinct template, label, is_phrase, m from trun),
band as (
  select a.id, a.template, a.d, count(distinct b.place) as covered
  from (select distinct id, template, d from cell) a join kind k using (template)
  join cell b on a.id = b.id and a.template = b.template and b.d between a.d and a.d + case when k.is_phrase then 0 else {license_scan.SHIFT} end
  group by all
), span as (
  select id, d, label, covered / m as score, is_phrase and covered = m as base, case when is_phrase then covered = m else covered * 5 >= m * 4 end as found
  from band join kind using (template)
), total as (
  select id, count(*) filter (base) as n_base, min(d) filter (base) as first_word, max(d) filter (base) as last_word,
         string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) filter (found) as labels, max(score) as score
  from span group by id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from word left join total using (id)
""",
        "op13_merkle": _merkle_sql(),
        "op2_top_k": f"""
with fine as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor({kd_search.SCALE:.0f} * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select row, vec_id, unnest(range(len(v))) as place, unnest(v) as part from fine
), scores as (
  select q.row as query, q.vec_id as query_id, c.row, c.vec_id, cast(sum(q.part * c.part) as bigint) as score
  from parts q join parts c on q.place = c.place and q.row <> c.row
  where q.vec_id % 50 = 0 group by all
), ranked as (
  select query_id, cast(row_number() over (partition by query order by score desc, vec_id) as int) as rank, vec_id, score from scores
)
select * from ranked where rank <= {kd_search.K}
""",
        "op8_line_dedup": f"""
with docs as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents
), line as (
  select doc_id, unnest(range(len(lines))) as pos, unnest(lines) as body from docs
), worded as materialized (
  select doc_id, pos, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') as words from line
), seen as materialized (
  select words, len(words) as n, min(struct_pack(doc_id := doc_id, pos := pos)) as first
  from worded where len(words) >= {line_dedup.MIN_WORDS} group by words
), variant as (
  select words, n, first, unnest(range(1, n + 1)) as i from seen where n >= {line_dedup.NEAR_WORDS}
), cut as (
  select words, n, first, i, array_to_string(words[1:i - 1], ' ') || ' / ' || array_to_string(words[i + 1:], ' ') as gap,
         array_to_string(words[1:i - 1] || words[i + 1:], ' ') as rest from variant
), replaced as (
  select words, first, min(first) over (partition by n, i, gap) as earliest from cut
), pair as (
  select c.words as a, c.first as fa, s.words as b, s.first as fb
  from cut c join seen s on s.n >= {line_dedup.NEAR_WORDS} and s.n = c.n - 1 and c.rest = array_to_string(s.words, ' ')
), near as (
  select words from replaced where earliest < first
  union select case when fa > fb then a else b end from pair
), gone as materialized (
  select w.doc_id, w.pos from worded w join seen s using (words)
  where struct_pack(doc_id := w.doc_id, pos := w.pos) <> s.first or w.words in (select words from near)
), kept as (
  select doc_id, string_agg(body, chr(10) order by pos) as text, count(*) as n_kept
  from line anti join gone using (doc_id, pos) group by doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       coalesce(len(d.lines), 0) as n_lines, coalesce(len(d.lines), 0) - coalesce(k.n_kept, 0) as n_removed
from docs d left join kept k using (doc_id)
""",
        "op7_url_rules": f"""
with cut as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from cut
), split as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from parts
), rules(rule_host, rule_path, rule_verdict) as (values {_rule_values()}),
fits as (
  select s.page_id, s.host, s.path, rule_host || rule_path as rule, rule_verdict,
         row_number() over (partition by s.page_id, s.host, s.path order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from split s join rules on (s.host = rule_host or ends_with(s.host, '.' || rule_host)) and starts_with(s.path, rule_path)
), best as (select distinct page_id, host, path, rule, rule_verdict from fits where place = 1)
select s.page_id, s.host, s.path, b.rule, coalesce(b.rule_verdict, 'allow') as verdict
from split s left join best b on s.page_id is not distinct from b.page_id and s.host = b.host and s.path = b.path
""",
    }

"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.chains import find_passages
from adloom.llm.clusters import cluster_vectors
from adloom.llm.codes import compress_vectors
from adloom.llm.decontaminate import find_contaminated
from adloom.llm.jaccard import near_duplicates
from adloom.llm.licenses import NOTICES, scan_licenses
from adloom.llm.linecrf import fit_lines, judge_lines
from adloom.llm.pieces import encode_nbest, piece_scores
from adloom.llm.simhash import near_fingerprints
from adloom.llm.suffixes import remove_repeats
from adloom.llm.templates import DEPTH, FREQUENT, MIN_SAME, drop_templates
from adloom.llm.tokens import prefix_token_counts
from adloom.llm.urls import judge_urls
from adloom.session import reach_workers

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return reach_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a customary license notice, and where it stands."""
    templates = spark.createDataFrame(NOTICES, "license string, text string")
    return scan_licenses(_table(spark, sf_dir, "documents"), templates)


#: Documents from which on a line template of the registered query recurs.
TEMPLATE_DOCS = 5


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many go with a recurring template, and the hash of the rest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    left = drop_templates(docs, min_docs=TEMPLATE_DOCS)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document, and how much of it fits into 1,024 of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = prefix_token_counts(docs, path, limit=1024, keep_prefixes=False)
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "fit_chars"
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best segmentations of every whole document, and whether each decodes to it.

    Of the second: score, number of pieces, the digest of its ids joined by commas, and whether it decodes to the
    document; null where there is none.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    found = encode_nbest(docs, path, n=2, keep="nbest", scores=piece_scores(docs, path))
    best = [F.get("scores", F.lit(i)).alias(name) for i, name in enumerate(("best_score", "second_score"))]
    ids = F.get("nbest", F.lit(1))["ids"]
    second = [
        F.when(ids.isNotNull(), F.size(ids)).cast("long").alias("second_n_pieces"),
        F.sha2(F.array_join(ids, ","), 256).alias("second_ids_sha256"),
        F.get("nbest", F.lit(1))["round_trip"].alias("second_round_trip"),
    ]
    return found.select("doc_id", "n_pieces", *best, "ids_sha256", "round_trip", *second)


#: The rules of the registered URL query.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge_urls(_table(spark, sf_dir, "pages"), rules)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 50-byte strings that an earlier one holds."""
    out = remove_repeats(_table(spark, sf_dir, "documents"), length=50)
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of 50 words or more that every document has from earlier ones."""
    found = find_passages(_table(spark, sf_dir, "documents"), min_words=50)
    passages = F.col("passages")
    return found.select(
        "doc_id",
        "n_words",
        F.size(passages).cast("long").alias("n_passages"),
        passages["start"].alias("starts"),
        passages["end"].alias("ends"),
        F.array_sort(F.array_distinct(passages["source"])).alias("sources"),
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item with at least 80 percent of the item's 5-word shingles in it."""
    return find_contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document and the verdict of rules and line model."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_lines(docs, _table(spark, sf_dir, "labels"))
    judged = judge_lines(docs, model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *names, "content_words", F.size("boilerplate_lines").alias("n_boilerplate_lines"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after five rounds from forty hashed starting points."""
    return cluster_vectors(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed="2:")


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every whole document, and the components of fingerprints within two bits."""
    return near_fingerprints(_table(spark, sf_dir, "documents"), k=3, most=2)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector from eight codebooks of sixteen entries, trained for six rounds."""
    return compress_vectors(_table(spark, sf_dir, "embeddings"), dims=64, parts=8, entries=16, rounds=6, scale=4096)


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_url_filter": op5_url_filter,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_quality_rules": op10_quality_rules,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = {}

# A-Z only, as the operator lower-cases; words parted by the six ASCII blanks.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op9_ngram_jaccard"] = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents
), s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from w
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.s = b.s and a.doc_id != b.doc_id group by 1, 2
), l as (
  select x, y from c join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 85 * (a.n + b.n - c)
), r as (
  select doc_id, doc_id as reached from documents
  union
  select r.doc_id, l.y from r join l on l.x = r.reached
)
select d.doc_id, coalesce(max(n.n), 0) as n_shingles, min(r.reached) as component_id
from documents d join r on r.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
group by d.doc_id
"""

SQL["op6_suffix_dedup"] = """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents
), w as (
  select doc_id, i, substr(h, 2 * i + 1, 100) as s from (select doc_id, h, unnest(range(0, n - 49)) as i from d where n >= 50)
), f as (
  select s, min(doc_id) as first from w group by s
), hit as (
  select distinct w.doc_id, w.i from w join f using (s) where f.first < w.doc_id
), b as (
  select doc_id, p, substr(h, 2 * p + 1, 2) as x from (select doc_id, h, unnest(range(0, n)) as p from d)
), l as (
  select b.doc_id, b.p, b.x, max(hit.i) over (partition by b.doc_id order by b.p) as last
  from b left join hit on hit.doc_id = b.doc_id and hit.i = b.p
), g as (
  select doc_id, p, x, coalesce(p - last < 50, false) as gone from l
), t as (
  select *, lag(gone, 1, false) over (partition by doc_id order by p) as before from g
), a as (
  select doc_id, count(*) filter (where gone) as n_removed, count(*) filter (where gone and not before) as n_spans,
    string_agg(x, '' order by p) filter (where not gone) as kept
  from t group by doc_id
)
select d.doc_id, cast(d.n as bigint) as n_bytes, coalesce(a.n_removed, 0) as n_removed, coalesce(a.n_spans, 0) as n_spans,
  sha256(unhex(coalesce(a.kept, ''))) as kept_sha256
from d left join a on a.doc_id = d.doc_id
"""

SQL["op5_url_filter"] = f"""
with u as (
  select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
  from pages
), p as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
  from u
), r (rule, host, start, verdict) as (
  values {", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in URL_RULES)}
), m as (
  select p.page_id, p.host, p.path, r.rule, r.verdict,
    row_number() over (partition by p.page_id order by length(r.rule) desc nulls last) as n
  from p left join r on (p.host = r.host or suffix(p.host, '.' || r.host)) and starts_with(p.path, r.start)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where n = 1
"""

SQL["op8_benchmark_decontamination"] = """
with b as (
  select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from benchmark
), bs as (
  select distinct item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s
  from b where len(w) >= 5
), d as (
  select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents
), ds as (
  select distinct doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as s
  from d where len(w) >= 5
), n as (
  select item_id, count(*) as n_item from bs group by item_id
)
select ds.doc_id, bs.item_id, count(*) as n_shared, max(n.n_item) as n_item
from ds join bs on ds.s = bs.s join n on n.item_id = bs.item_id
group by 1, 2 having 100 * count(*) >= 80 * max(n.n_item)
"""

SQL["op2_line_dedup"] = f"""
with l as (
  select doc_id, i, x[i] as line, len(x) as n_lines
  from (select doc_id, x, unnest(range(1, len(x) + 1)) as i from (select doc_id, string_split(text, chr(10)) as x from documents))
), p as (
  select *, trim(regexp_replace(line, '[ \\t\\x0B\\f\\r]+', ' ', 'g')) as plain from l
), m as (
  select doc_id, i, line, n_lines, case when 2 * len(list_filter(string_split(plain, ' '), lambda x: regexp_matches(x, '[0-9]')))
    <= len(string_split(plain, ' ')) then regexp_replace(plain, '[0-9]+', '<*>', 'g') else plain end as t from p
), k as (
  select *, len(string_split(t, ' ')) as n, array_to_string(string_split(t, ' ')[1:{DEPTH}], ' ') as lead from m where t != ''
), e as (
  select t, min(doc_id) as first from k group by t having count(distinct doc_id) >= {TEMPLATE_DOCS}
), r as (
  select * from k where n > {DEPTH} and t not in (select t from e)
), f as (
  select n, lead from r group by n, lead having count(distinct doc_id) >= {TEMPLATE_DOCS}
), u as (
  select distinct r.n, r.lead, r.t from r join f on r.n = f.n and r.lead = f.lead
), w as (
  select n, lead, t, x[q] as token, q
  from (select n, lead, t, string_split(t, ' ') as x, unnest(range(1, n + 1)) as q from u)
), z as (
  select n, lead, count(*) as lines from u group by n, lead
), c as (
  select w.n, w.lead, w.q, w.token from w join z on w.n = z.n and w.lead = z.lead
  group by w.n, w.lead, w.q, w.token, z.lines
  having (count(*) >= {TEMPLATE_DOCS} and {FREQUENT} * count(*) >= z.lines) or 2 * count(*) > z.lines
), s as (
  select w.n, w.lead, w.t, list((w.q, w.token) order by w.q) as constants
  from w join c on w.n = c.n and w.lead = c.lead and w.q = c.q and w.token = c.token
  group by w.n, w.lead, w.t having 100 * count(*) filter (where not contains(w.token, '<*>')) >= {MIN_SAME} * w.n
), g as (
  select s.n, s.lead, s.constants, min(r.doc_id) as first from r join s on r.t = s.t
  group by s.n, s.lead, s.constants having count(distinct r.doc_id) >= {TEMPLATE_DOCS}
), gone as (
  select k.doc_id, k.i from k join e on k.t = e.t where k.doc_id != e.first
  union all
  select k.doc_id, k.i from k join s on k.t = s.t join g on g.n = s.n and g.lead = s.lead and g.constants = s.constants
  where k.doc_id != g.first
), kept as (
  select l.doc_id, count(gone.i) as n_dropped, max(l.n_lines) as n_lines,
    string_agg(l.line, chr(10) order by l.i) filter (where gone.i is null) as text
  from l left join gone on gone.doc_id = l.doc_id and gone.i = l.i group by l.doc_id
)
select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_dropped, 0) as n_dropped,
  case when d.text is not null then sha256(coalesce(k.text, '')) end as kept_sha256
from documents d left join kept k on k.doc_id = d.doc_id
"""

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint))"


def _squared(a: str, b: str, n: int) -> str:
    return f"list_sum(list_transform(range(1, {n + 1}), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"


def _floored(total: str, n: str) -> str:
    return f"cast(({total} - (({total} % {n}) + {n}) % {n}) // {n} as bigint)"


def _clusters_sql(k: int, rounds: int, dims: int, scale: int) -> str:
    """Lloyd's rounds one after another, every vector against every centroid."""
    steps = [
        f"v as materialized (select vec_id, {_whole(scale)} as v from embeddings where len(embedding) = {dims} and {_FINITE})",
        f"""c0 as materialized (select row_number() over (order by h) - 1 as c, v from (
          select v, sha256('2:' || vec_id) as h from v order by h limit {k}))""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (select vec_id, v, c, d from (select v.vec_id, v.v, c, {_squared("v.v", "k.v", dims)} as d
          from v cross join c{r} k) qualify row_number() over (partition by vec_id order by d, c) = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} as materialized (select k.c, coalesce(m.v, k.v) as v from c{r} k left join (
              select c, list(x order by i) as v from (select c, i, {_floored("sum(v[i])", "count(*)")} as x
                from (select c, v, unnest(range(1, {dims + 1})) as i from a{r}) group by c, i) group by c) m on m.c = k.c)""")
    return f"""with {", ".join(steps)}
      select a.vec_id, cast(a.c as int) as cluster, cast(a.d as bigint) as distance,
        cast(sum(a.d) over (partition by a.c) as bigint) as cluster_inertia, cast(sum(a.d) over () as bigint) as inertia,
        sha256(array_to_string(k.v, ',')) as centroid_sha256
      from a{rounds} a join c{rounds} k on k.c = a.c"""


def _codes_sql(parts: int, entries: int, rounds: int, dims: int, scale: int) -> str:
    """Every part against every entry of its codebook, round by round."""
    width = dims // parts
    steps = [
        f"w as materialized (select vec_id, label, {_whole(scale)} as v from embeddings where len(embedding) = {dims} and {_FINITE})",
        f"v as materialized (select vec_id, p, v[p * {width} + 1:(p + 1) * {width}] as v from (select vec_id, v, unnest(range({parts})) as p from w))",
        f"""b0 as materialized (select p, dense_rank() over (order by vec_id) - 1 as e, v from v
          where vec_id in (select vec_id from w order by vec_id limit {entries}))""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (select vec_id, p, v, e, d from (select v.vec_id, v.p, v.v, b.e, {_squared("v.v", "b.v", width)} as d
          from v join b{r} b on b.p = v.p) qualify row_number() over (partition by vec_id, p order by d, e) = 1)""")
        if r < rounds:
            steps.append(f"""b{r + 1} as materialized (select b.p, b.e, coalesce(m.v, b.v) as v from b{r} b left join (
              select p, e, list(x order by i) as v from (select p, e, i, {_floored("sum(v[i])", "count(*)")} as x
                from (select p, e, v, unnest(range(1, {width + 1})) as i from a{r}) group by p, e, i) group by p, e) m on m.p = b.p and m.e = b.e)""")
    return f"""with {", ".join(steps)}, f as (
        select vec_id, string_agg(printf('%02x', cast(e as int)), '' order by p) as code, cast(sum(d) as bigint) as error
        from a{rounds} group by vec_id
      )
      select f.vec_id, f.code, f.error, cast(sum(f.error) over (partition by w.label) as bigint) as label_error,
        (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from b{rounds}) as codebooks_sha256
      from f join w on w.vec_id = f.vec_id"""


SQL["op11_centroid_clustering"] = _clusters_sql(k=40, rounds=5, dims=64, scale=256)
SQL["op13_vector_codes"] = _codes_sql(parts=8, entries=16, rounds=6, dims=64, scale=4096)

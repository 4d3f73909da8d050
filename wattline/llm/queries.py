"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    alignment,
    hyperplanes,
    language,
    lines,
    minhash,
    mixing,
    pieces,
    quality,
    secrets,
    spelling,
    token_files,
    vp_tree,
    warc_zip,
)
from wattline.llm.common import table
from wattline.session import materialize


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    rows = mixing.keyed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    narrow = materialize(rows.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "key", "tie"), "mix-keys")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.decide(narrow, mixing.cuts(narrow)).select("doc_id", "size", "source_size", "target", taken)


OP1_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    -ln((('0x' || substr(md5('mix' || coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5::double) / 4503599627370496::double)
      / greatest(0.125::double, least(1::double, coalesce(case when length(text) > 0 then
          length(regexp_replace(text, '[^A-Za-zÀ-ɏ]+', '', 'g'))::double / length(text)::double end, 0))) as key
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][((row_number() over (order by source nulls last)) - 1) % 3 + 1] as weight from s),
o as (select *, row_number() over (order by source_size::double / weight, source nulls last) as place from w),
c as (
  select *,
    (sum(source_size) over () - coalesce(sum(source_size * 3) over (order by place rows between unbounded preceding and 1 preceding), 0))::double as rest,
    (sum(weight) over (order by place rows between current row and unbounded following))::double as weights
  from o),
f as (select min(place) as place from c where rest * weight / weights < (source_size * 3)::double),
l as (select rest, weights from c where place = (select place from f)),
t as (
  select source, source_size,
    case when place >= (select place from f) then (select rest from l) * weight / (select weights from l)
      else (source_size * 3)::double end as target
  from c),
e as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from t),
r as (
  select d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size as rest,
    sum(d.size) over (partition by d.source order by d.key, d.doc_id) as upto
  from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target,
  (size * (epochs + case when 2 * upto - size <= 2 * rest then 1 else 0 end))::bigint as taken
from r
"""


def op2_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page, read back from the packages."""
    path = warc_zip.save(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc_zip.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html)::bigint as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d),
r as (select *, case when payload_bytes >= 100 and page_id <> first then first end as refers_to from f)
select page_id, payload_bytes, payload_digest,
  case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to
from r
"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = table(spark, sf_dir, "documents").select("doc_id", secrets.spans(F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        *[secrets.count(F.col("found"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.listed(secrets.base_only(F.col("found"))).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("found")).alias("spans"),
    )


OP3_SQL = r"""
with recursive d as (select doc_id, coalesce(text, '') as text from documents),
k as (select * from (values
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]+', 0, 24), (3, 'candidate', '[A-Za-z0-9+/_=-]{20,}', 0, 20)
  ) as k(kind, name, pattern, grp, least)),
p as (
  select doc_id, kind, name, pattern, grp, least, string_split_regex(text, pattern) as gaps, regexp_extract_all(text, pattern) as found
  from d, k where regexp_matches(text, pattern)),
m as (
  select doc_id, kind, name, pattern, grp, least, found[i] as text,
    list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as start
  from (select *, unnest(range(1, len(found) + 1)) as i from p)),
b as (
  select doc_id, start::bigint as start, kind, name, (start + length(text))::bigint as stop from m
  where kind < 3 and length(case kind when 0 then regexp_extract(text, pattern, 2) else text end) >= least),
t as (select list_transform(range(0, 21), lambda c: case when c = 0 then 0 else round(c * log2(c) * 1000000)::bigint end) as terms),
c as (
  select doc_id, start, text, regexp_matches(text, '^[0-9a-fA-F]+$') as hex from m
  where kind = 3
    and not regexp_matches(text, '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$')
    and not regexp_matches(text, '^[A-Za-z+/_=-]+$') and not regexp_matches(text, '^[0-9+/_=-]+$')),
u as (select *, string_split_regex(text, '[/_-]') as parts, UUIDS as marked from c),
v as (
  select doc_id, start, text, hex, string_split_regex(BARRED, '[+/_=-]') as own,
    len(parts) > 1 and (
      len(list_filter(parts[:-2], lambda p: not regexp_matches(p, '^[A-Za-z]+$'))) = 0 and regexp_matches(parts[-1], '^[A-Za-z0-9]*$')
      or len(list_filter(parts[:-2], lambda p: not regexp_matches(p, '^[A-Za-z0-9]{1,15}$'))) = 0
        and regexp_matches(parts[-1], '^[A-Za-z0-9]{0,15}$')) as path
  from u),
q as (
  select *, regexp_extract_all(array_to_string(list_transform(own, lambda p: regexp_replace(p, '[^!]',
    case when not (regexp_matches(p, '[0-9]') and regexp_matches(p, '[A-Za-z]')) then '.'
      when regexp_matches(p, '^[0-9a-fA-F]+$') then 'h' else '#' end, 'g')), '.'), '[.!]+|[^.!]+') as runs
  from v),
z as (
  select doc_id, start, text, hex, case when path then mask else translate(mask, '.h', '##') end as mask
  from (select *, array_to_string(list_transform(runs, lambda r: case when contains(r, '!') then replace(r, '.', '!') else r end), '') as mask
    from q)),
w as (select doc_id, start, hex, i, substr(mask, i + 1, 20) as signs, string_split(substr(text, i + 1, 20), '') as chars
  from (select *, unnest(range(0, length(text) - 19)) as i from z)),
x as (
  select doc_id, start, i, signs, hex,
    list_sum(list_transform(list_distinct(chars), lambda x: terms[len(list_filter(chars, lambda y: y = x)) + 1])) as total
  from w, t),
h as (
  select doc_id, start, i from x
  where not contains(signs, '!') and total <= floor((log2(20) - 2.9) * 20 * 1000000)
    and (signs = 'hhhhhhhhhhhhhhhhhhhh'
      or regexp_matches(signs, '[#h]') and total <= floor((log2(20) - case when hex then 2.9 else 3.8 end) * 20 * 1000000))),
g as (select *, i - lag(i) over (partition by doc_id, start order by i) > 20 as fresh from h),
n as (select *, sum(case when fresh then 1 else 0 end) over (partition by doc_id, start order by i) as island from g),
e as (
  select doc_id, (start + min(i))::bigint as start, 3 as kind, 'entropy' as name, (start + max(i) + 20)::bigint as stop
  from n group by doc_id, n.start, island),
a as (select * from b union all select * from e),
s as (
  select doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
    string_agg(name || ':' || start || ':' || stop, ',' order by start, kind) filter (kind < 3) as base,
    string_agg(name || ':' || start || ':' || stop, ',' order by start, kind, stop) as spans
  from a group by doc_id)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join s using (doc_id)
"""


# A UUID among other parts counts as letters. A match takes its neighbours along, so that of two in a row the second needs a second turn.
_UUIDS = "text"
for _ in range(2):
    _UUIDS = (
        rf"regexp_replace({_UUIDS}, '(^|[+/_=-])[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}($|[+/_=-])', "
        r"'\1gggggggg-gggg-gggg-gggg-gggggggggggg\2', 'g')"
    )
_BARRED = "marked"
for _word in ("example", "sample", "dummy", "placeholder", "test", "xxxx", "1234567890", "abcdefgh"):
    _BARRED = f"regexp_replace({_BARRED}, '(?i){_word}', '{'!' * len(_word)}', 'g')"
OP3_SQL = OP3_SQL.replace("UUIDS", _UUIDS).replace("BARRED", _BARRED)


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return vp_tree.search(vp_tree.build(vectors), vectors.where("vec_id % 20 = 0"), factor=1.0)


OP4_SQL = """
with v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (
  select a.vec_id as query_id, b.vec_id, list_inner_product(a.e, b.e) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= 20
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before and after removing shared ones, and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


OP5_SQL = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
k as (
  select *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
s as (
  select key, max(doc_id) as keeper from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
f as (select k.*, s.keeper is not null and s.keeper <> k.doc_id as gone from k left join s using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from f group by doc_id
"""

def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and whether they decode to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = docs.withColumn("ids", pieces.encode(F.col("text"), model))
    decoded = coded.withColumn("decoded", pieces.decode(F.col("ids"), model))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("same_text"),
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document lies among all ids, read back from the written files."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = token_files.save(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    found = token_files.read(spark, path).select("file", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return token_files.with_starts(materialize(found, "token-places")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.with_score(docs, model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
m as (select x.doc_id as a, y.doc_id as b, count(*) as common from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id
  group by all),
p as (
  select a, b from m join n x on x.doc_id = a join n y on y.doc_id = b where 100 * common >= 75 * (x.n + y.n - common)),
r as (select a as node, a as reached from p union select r.node, p.b from r join p on r.reached = p.a),
c as (select node, min(reached) as root from r group by node)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(root, d.doc_id) as component_id,
  coalesce(root, d.doc_id) = d.doc_id as kept
from documents d left join n on n.doc_id = d.doc_id left join c on c.node = d.doc_id
"""


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return hyperplanes.near_vectors(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
r as (select a as node, a as reached from p union select r.node, p.b from r join p on r.reached = p.a),
c as (select node, min(reached) as root from r group by node),
n as (select a, count(*) as links from p group by a)
select vec_id, coalesce(links, 0)::bigint as n_links, coalesce(root, vec_id) as component_id,
  coalesce(root, vec_id) = vec_id as kept
from embeddings left join n on n.a = vec_id left join c on c.node = vec_id
"""


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    found = docs.select("doc_id", language.with_language(docs, model, F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, the form it most likely means, and the end of its chain of forms."""
    runs = spelling.runs(table(spark, sf_dir, "documents"), least=spelling.LEAST_LETTERS)
    words = runs.select(spelling.with_slips(F.col("doc_id"), F.col("run"), 97).alias("word"))
    return spelling.variants(materialize(spelling.vocabulary(words), "vocabulary"))


OP12_SQL = r"""
with recursive t as (
  select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as crc
  from range(256) as r(i)),
r as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
d as (select doc_id, run, count(*) as n from r where length(run) >= 5 group by all),
b as (
  select *, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda c: case when unicode(c) < 128 then [unicode(c)] else [195, unicode(c) - 64] end))::bigint[] as bytes
  from d),
h as (
  select run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c // 256, crc[xor(c, x) % 256 + 1])), 4294967295) as h
  from b, t),
s as (
  select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from h),
w as (select word, sum(n)::bigint as n from s where length(word) >= 5 group by word having sum(n) >= 3),
c as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from w)),
p as (
  select a.word, b.word as near from c a join c b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select c.word, w.word from c join w on c.rest = w.word
  union select w.word, c.word from c join w on c.rest = w.word),
g as (
  select p.word, count(*)::bigint as n_near, min(struct_pack(less := -w.n, near := p.near)) as best
  from p join w on w.word = p.near group by p.word),
f as (
  select w.word, w.n, coalesce(n_near, 0)::bigint as n_near,
    case when -best.less >= 2 * w.n then best.near end as form, case when -best.less >= 2 * w.n then -best.less end as form_n
  from w left join g using (word)),
x as (
  select word, word as root, 0 as steps from f union all select x.word, f.form, steps + 1 from x join f on f.word = x.root where f.form is not null),
e as (select word, arg_max(root, steps) as root from x group by word)
select word, form, root, n, n_near, form_n::bigint as form_n from f join e using (word)
"""


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two vocabularies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(docs, *paths, digest=True).withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_warc_packages": op2_warc_packages,
    "op3_secrets": op3_secrets,
    "op4_nearest_vectors": op4_nearest_vectors,
    "op5_line_dedup": op5_line_dedup,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_token_files": op7_token_files,
    "op8_quality": op8_quality,
    "op9_near_documents": op9_near_documents,
    "op10_near_vectors": op10_near_vectors,
    "op11_language": op11_language,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES = {
    "op1_mix_sources": OP1_SQL,
    "op2_warc_packages": OP2_SQL,
    "op3_secrets": OP3_SQL,
    "op4_nearest_vectors": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op9_near_documents": OP9_SQL,
    "op10_near_vectors": OP10_SQL,
    "op12_spelling_variants": OP12_SQL,
}

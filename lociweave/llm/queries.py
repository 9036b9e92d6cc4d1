"""The operators of this subpackage as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm import chat_format, chat_repair, multi_index, packing, qda, ranked_search, simhash, sparse_suffixes, superkmer, templates, token_counts, tokenizer, url_filter, warc
from lociweave.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces with the length and checksum of their ids instead of the ids."""
    length = (F.length("ids") / 4).cast("long")
    checked = pieces.withColumns({"length": length, "ids_crc32": F.crc32("ids")})
    return checked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register
def op1_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return digest_pieces(packing.pack_documents(docs, tokenizer.vocabulary_file(VOCABULARY)))


@register
def op9_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, tokenizer.vocabulary_file(VOCABULARY))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@register
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op2_superkmer(spark, sf_dir):
    return superkmer.removal_report(table(spark, sf_dir, "documents"))


@register
def op5_qda(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return qda.score_documents(docs, labels, materialise)


URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
#: Words in hosts that label a URL as one to block, for training.
SPAM_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")


@register
def op6_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    labelled = url_filter.labelled_urls(pages, URL_RULES, SPAM_WORDS)
    return url_filter.judge(pages, URL_RULES, materialise, labelled)


@register
def op8_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), warc.archive_folder(spark), materialise)


# sha1 in hexadecimal becomes base32: five hexadecimal digits are four letters.
ORACLES["op8_warc"] = """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body)) as n, sha1(body) as hex, min(page_id) over (partition by body) as f from p),
v as (select *, [('0x' || substr(hex, 5 * i + 1, 5))::int for i in range(8)] as twenty from d)
select page_id, n::bigint as payload_bytes,
 array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1) for s in [15, 10, 5, 0]], '') for x in twenty], '') as payload_digest,
 case when page_id is not distinct from f then 'response' else 'revisit' end as record_type,
 case when page_id is distinct from f then f end as refers_to from v
"""


@register
def op7_multi_index(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return multi_index.search(vectors, F.col("vec_id") % 100 == 0, materialise)


@register
def op3_templates(spark, sf_dir):
    found = templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key").distinct()


@register
def op4_sparse_suffixes(spark, sf_dir):
    return sparse_suffixes.repeated_passages(table(spark, sf_dir, "documents"), materialise)


@register
def op11_chat_repair(spark, sf_dir):
    rows = chat_repair.damaged(table(spark, sf_dir, "conversations"))
    verdict, turns = chat_repair.repair(rows)
    told = verdict.alias("v").join(chat_repair.digests(turns).alias("d"), F.col("v.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
    return told.select("v.*", digest.alias("repaired_sha256"))


# The damage's checksum bit by bit; the cheapest edits by a walk along the turns, with the best
# (cost, audit) of each state of the conversation and at most two inserted turns in a row.
ORACLES["op11_chat_repair"] = r"""
with recursive o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
h as (select *, xor(list_reduce([4294967295::bigint] || [ascii(substr(key, i, 1))::bigint for i in range(1, length(key) + 1)],
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 as kind from o),
d as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
  case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy from h where kind <> 0),
i as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as k from d),
n as (select *, row_number() over (partition by conv_id, role, text order by k) as again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) as ending from i),
r as (select conv_id, turn, role, text, k, substr(role, 1, 1) as initial, ending = '' as blank, ending <> '' and again > 1 as duplicate,
  ending <> '' and again = 1 and ending not in ('.', '!', '?') as truncated from n),
f as (select conv_id, case when count(turn) = 0 then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end as gaps, count(*) filter (where blank) as blank,
  count(*) filter (where duplicate) as duplicate, count(*) filter (where truncated) as truncated, count(*) as n from r group by conv_id),
l as (select conv_id, count(*) as illegal from (select conv_id, lag(initial) over (partition by conv_id order by k) || initial as two from r) where two not in ('su', 'ua', 'au') group by conv_id),
e(p, q, cost, audit) as (values ('0', '0', 0, ''), ('s', 's', 0, ''), ('u', 'u', 0, ''), ('a', 'a', 0, ''), ('0', 'u', 2, 'I'), ('s', 'u', 2, 'I'), ('a', 'u', 2, 'I'),
  ('u', 'a', 2, 'I'), ('0', 'a', 4, 'II'), ('s', 'a', 4, 'II'), ('u', 'u', 4, 'II'), ('a', 'a', 4, 'II')),
m(p, initial, q) as (values ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
t as (select r.conv_id, r.k, p.p, p.p as q, 3 as cost, 'D' as audit from r, (select distinct p from e) p
 union all select conv_id, k, p, q, truncated::int, 'K' from r join m using (initial) where not blank and not duplicate
 union all select conv_id, k, p, q, 2 + truncated::int, 'R' from r, m where m.initial <> 's' and not blank and not duplicate),
w(conv_id, k, state, v) as (select conv_id, 0::bigint, q, {'cost': cost::bigint, 'audit': audit} from (select distinct conv_id from r), e where p = '0'
 union all select w.conv_id, t.k, e.q, min({'cost': w.v.cost + t.cost + e.cost, 'audit': w.v.audit || t.audit || e.audit})
 from w join t on t.conv_id is not distinct from w.conv_id and t.k = w.k + 1 and t.p = w.state join e on e.p = t.q group by 1, 2, 3),
b as (select w.conv_id, min(v) as v from w join f on f.conv_id is not distinct from w.conv_id where k = n and state in ('0', 'a') group by w.conv_id),
c as (select conv_id, i, substr(v.audit, i, 1) as edit, length(regexp_replace(substr(v.audit, 1, i), 'I', '', 'g')) as k from (select conv_id, v, unnest(range(1, length(v.audit) + 1)) as i from b)),
z as (select c.conv_id, i, edit, r.role, case when edit = 'I' then '' else r.text end as text, row_number() over g - 1 as j, first_value(edit = 'K' and r.initial = 's') over g as led
 from c left join r on r.conv_id is not distinct from c.conv_id and r.k = c.k and edit <> 'I' where edit <> 'D' window g as (partition by c.conv_id order by i)),
y as (select conv_id, sha256(string_agg(case when edit = 'K' then role when (j - led::int) % 2 = 0 then 'user' else 'assistant' end || ':' || text, chr(10) order by i)) as sha from z group by conv_id)
select x.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
 coalesce(illegal, 0)::bigint as illegal, coalesce(v.cost, 0)::bigint as cost, coalesce(v.audit, '') as audit, coalesce(sha, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) x left join f on f.conv_id is not distinct from x.conv_id left join l on l.conv_id is not distinct from x.conv_id
left join b on b.conv_id is not distinct from x.conv_id left join y on y.conv_id is not distinct from x.conv_id
"""


@register
def op12_lexical_search(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_lexical_search"] = r"""
with cut as (select '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' as term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as upper, 'abcdefghijklmnopqrstuvwxyz' as lower),
d as (select row_number() over () as row, doc_id, regexp_extract_all(translate(text, upper, lower), term) as terms from documents, cut),
held as (select row, doc_id, len(terms)::bigint as n, terms from d where len(terms) > 0),
al as (select count(*)::bigint as nn, sum(n)::bigint as ll from held),
tf as (select row, doc_id, n, t, count(*)::bigint as tf from (select row, doc_id, n, unnest(terms) as t from held) group by all),
i as (select item_id, t, count(*)::bigint as often from (select item_id, row_number() over () as row, unnest(regexp_extract_all(translate(text, upper, lower), term)) as t from benchmark, cut) group by all),
w as (select t, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::bigint as w from tf, al where t in (select t from i) group by t),
s as (select item_id, row, doc_id, sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nn) // ll)))))::bigint as score
 from i join w using (t) join tf using (t), al group by all),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from s where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 20
"""


@register
def op13_prefix_targets(spark, sf_dir):
    probe = [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    talks = talks.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))
    return chat_format.read_back(chat_format.expand(talks))


ORACLES["op13_prefix_targets"] = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
n as (select *, row_number() over w as k, row_number() over w = count(*) over (partition by conv_id) as last
 from c window w as (partition by conv_id order by turn nulls first, role, text)),
e as (select *, length('<|im_start|>') + length(replace(replace(regexp_replace(role, marks, '\1\\\2\3', 'g'), '\', '\\'), chr(10), '\n')) + 1
 + length(regexp_replace(text, marks, '\1\\\2\3', 'g')) + length('<|im_end|>') + 1 as size
 from n, (select '([<\[])(\\*)(\|startoftext\|>|\|endoftext\|>|\|im_start\|>|\|im_end\|>|</SYS>>|/INST\]|<SYS>>|INST\]|unk>|/s>|s>)' as marks)),
t as (select *, sum(size) over (partition by conv_id order by k) as upto from e)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
 coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
 sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), '')) as loss_sha256,
 coalesce(sum(upto) filter (where role = 'assistant' or last), 0)::bigint as formatted_chars
from t group by conv_id
"""

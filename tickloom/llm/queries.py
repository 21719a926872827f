"""The registered queries of this package and the SQL that must give the same rows.

Where SQL can't express a query (tokenizers, XXH64, learned models) ``tests/llm`` holds it
against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import WORD
from tickloom.llm.decontaminate import contamination, is_contaminated
from tickloom.llm.filter_audit import audit_documents
from tickloom.llm.licenses import scan_licenses
from tickloom.llm.line_dedup import drop_boilerplate
from tickloom.llm.lm_scoring import cross_entropy_difference, good_documents
from tickloom.llm.mixing import mix
from tickloom.llm.periodic_runs import with_runs
from tickloom.llm.quality_rules import fit_rules, judge
from tickloom.llm.secrets import BASE_KINDS, KINDS, find_secrets
from tickloom.llm.simhash import near_duplicates
from tickloom.llm.substring_dedup import remove_repeated_windows
from tickloom.llm.token_counts import token_counts
from tickloom.llm.warc import archive_pages

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archive_pages(table(spark, sf, "pages", "page_id", "url", "html"))


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    found = contamination(docs, table(spark, sf, "benchmark", "item_id", "text"), "found", ["doc_id"])
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op3_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents", "doc_id", "text"))


def op4_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    training = good_documents(docs, table(spark, sf, "labels", "doc_id", "quality", "toxic"))
    return cross_entropy_difference(docs, training, "lm", ["doc_id"]).select("doc_id", "lm.*")


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts(table(spark, sf, "documents", "doc_id", "text"), tokenizer_path(), "tokens", ["doc_id"])
    return counted.select("doc_id", "tokens.*", (F.col("tokens.n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = remove_repeated_windows(table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(table(spark, sf, "documents", "doc_id", "text"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id", "n_copies")


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "source", "text")
    found = drop_boilerplate(docs, F.col("source"))
    return found.select(
        "doc_id", "source", "lines.n_lines", "lines.n_removed", F.sha2("lines.text", 256).alias("kept_sha256")
    )


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    rules = fit_rules(docs, table(spark, sf, "labels", "doc_id", "quality"))
    found = judge(docs, rules, "quality", ["doc_id"])
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
    return found.select("doc_id", *[f"quality.{c}" for c in columns])


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    found = mix(table(spark, sf, "documents", "doc_id", "source", "text"))
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def _spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def op11_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = find_secrets(table(spark, sf, "documents", "doc_id", "text"), "secrets", ["doc_id"])
    spans = F.col("secrets.spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(_spans(base), 256).alias("base_sha256"),
        _spans(spans).alias("spans"),
    )


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    return audit_documents(docs, table(spark, sf, "labels", "doc_id", "quality", "toxic"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by the CRC-32 of its id ends in a repeated stretch.

    Texts without words or an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g, words = F.floor(h / 10), F.col("words")
    n, a, p = F.col("n"), F.col("a"), F.col("p")
    chosen = docs.withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))))
    chosen = chosen.withColumn("n", F.when(F.size("words") > 0, F.size("words").cast("long")))
    chosen = chosen.withColumn("a", g % n).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int")))
    return chosen.select("doc_id", F.when(n.isNull(), F.col("text")).otherwise(F.array_join(repeated, " ")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf, "documents", "doc_id", "text"))
    found = with_runs(docs, "found", ["doc_id"])
    runs = F.col("found.runs")
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    longest = F.array_max(ranked)
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        (-longest["start"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["period"]).alias("period"),
        F.floor(1000 * longest["length"] / (-longest["period"])).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_decontamination,
        op3_licenses,
        op4_lm_scoring,
        op5_token_counts,
        op6_substring_dedup,
        op7_simhash,
        op8_line_dedup,
        op9_quality_rules,
        op10_mixing,
        op11_secrets,
        op12_filter_audit,
        op13_periodic_runs,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = {
    "op1_warc": """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, octet_length(encode(body)) as payload_bytes, sha1(body) as payload_digest from p),
m as (select *, max(page_id) over (partition by payload_digest) as latest from d)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id is distinct from latest and latest is not null
        then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id is distinct from latest then latest end as refers_to
from m""",
    "op2_decontamination": f"""
with iw as (select coalesce(cast(item_id as varchar), '') as item_id, {_NORMAL_WORDS} as ws from benchmark),
i as (select item_id, ws, len(ws) as n, least(13, len(ws)) as width from iw where len(ws) > 0),
windows as (
    select distinct item_id, width, array_to_string(ws[k:k + width - 1], ' ') as win
    from (select *, unnest(range(1, n - width + 2)) as k from i)),
d as (select doc_id, {_NORMAL_WORDS} as ws from documents),
spots as (
    select doc_id, width, k, array_to_string(ws[k:k + width - 1], ' ') as win
    from (select doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) as k
          from d, (select distinct width from windows) where len(ws) >= width)),
found as (select doc_id, k, spots.width, item_id from spots join windows using (width, win)),
hit as (select doc_id, count(distinct w) as n_hit
        from (select doc_id, unnest(range(k, k + width)) as w from found) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
          from (select distinct doc_id, item_id from found) group by 1)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join hit using (doc_id) left join items using (doc_id)""",
    "op6_substring_dedup": f"""
with d as (select doc_id, {_WORDS} as ws from documents),
w as (select doc_id, k, array_to_string(ws[k:k + 49], ' ') as win
      from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as k from d where len(ws) >= 50)),
gone as (select doc_id, k from (select doc_id, k, min(doc_id) over (partition by win) as first from w) where first < doc_id),
removed as (select distinct doc_id, p from (select doc_id, unnest(range(k, k + 50)) as p from gone)),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from d),
kept as (select doc_id, count(*) as n_kept, string_agg(word, ' ' order by p) as kept
         from words anti join removed using (doc_id, p) group by 1)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n_kept, 0) as bigint) as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from d left join kept using (doc_id)""",
    "op8_line_dedup": r"""
with d as (select doc_id, source, text, string_split(text, chr(10)) as lines from documents),
pages as (select distinct source, text from documents),
keyed as (
    select distinct source, text, regexp_replace(line, '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+\z', '', 'g') as key
    from (select source, text, unnest(string_split(text, chr(10))) as line from pages)),
hosts as (select source as host, count(*) as n_host from (select distinct source, coalesce(text, '') from documents) group by 1),
gone as (
    select host, key from
        (select source, key, count(*) as n_pages from keyed where key <> '' group by 1, 2) as c
        join hosts on source is not distinct from host
    where n_pages >= 5 and n_pages > 0.1 * n_host),
numbered as (
    select doc_id, source, unnest(lines) as line, unnest(range(len(lines))) as p from d),
left_ as (
    select doc_id, count(*) as n_left, string_agg(line, chr(10) order by p) as kept
    from numbered where not exists (
        select 1 from gone where host is not distinct from source
        and key = regexp_replace(line, '^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+\z', '', 'g'))
    group by 1)
select doc_id, source, cast(coalesce(len(lines), 0) as bigint) as n_lines,
    cast(coalesce(len(lines), 0) - coalesce(n_left, 0) as bigint) as n_removed,
    case when text is not null then sha256(coalesce(kept, '')) end as kept_sha256
from d left join left_ using (doc_id)""",
    "op10_mixing": f"""
with d as (
    select doc_id, source, cast(len({_WORDS}) as bigint) as size,
        (('0x' || substr(md5('mix|' || cast(doc_id as varchar)), 1, 12))::bigint + 0.5::double) / 281474976710656.0::double as u
    from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by 1),
ranked as (
    select *, [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight,
        2 * source_size::double as cap, row_number() over (order by source nulls last) as place from s),
placed as (
    select *, sum(cap) over need - cap as before, (sum(weight) over ()) - (sum(weight) over need) + weight as open,
        cast(sum(source_size) over () as double) * 1.5::double as words
    from ranked window need as (order by cap / weight, place)),
leveled as (select *, (words - before) / open as level from placed),
cut as (select arg_min(level, (cap / weight, place)) as level from leveled where level * weight <= cap),
t as (select source, source_size, coalesce(least(cap, (select level from cut) * weight), cap) as target from ranked),
c as (
    select d.*, source_size, target, least(target / nullif(source_size, 0), 2.0::double) as wanted
    from d join t on d.source is not distinct from t.source),
e as (select *, cast(floor(coalesce(wanted, 0)) as bigint) as certain from c),
n as (
    select *, target - sum(certain * size) over (partition by source) as need,
        case when size > 0 and certain < 2 then
            sum(case when size > 0 and certain < 2 then size end) over (partition by source order by u, doc_id) end as upto
    from e),
x as (
    select *, coalesce(need >= 0.5 and (upto <= need or (upto - size < need and abs(upto - need) < abs(upto - size - need))), false)
        as extra from n)
select doc_id, source, size, source_size, target,
    case when size > 0 then certain + cast(extra as bigint) else 0 end as copies,
    (case when size > 0 then certain + cast(extra as bigint) else 0 end) * size as taken
from x""",
    "op12_filter_audit": rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body, {_WORDS} as ws from documents),
known as (select doc_id, max(cast(coalesce(quality, 0) = 1 as int)) as good, max(cast(coalesce(toxic, 0) = 1 as int)) as toxic
          from labels where doc_id is not null group by 1),
f as (
    select part, cast(len(ws) < 200 as int) as a, cast(100 * len(list_distinct(ws)) < 50 * len(ws) as int) as b,
        cast(100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) as int) as c,
        cast(regexp_matches(body, '[#$%&*|]') as int) as d,
        cast(coalesce(d.doc_id > min(d.doc_id) over (partition by body), false) as int) as e,
        coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
    from d left join known on d.doc_id = known.doc_id),
cells as (select part, [a, b, c, d, e] as fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by all),
l as (select unnest([1, 2, 3, 4, 5]) as k),
orders as (
    select [l1.k, l2.k, l3.k, l4.k, l5.k] as ks from l as l1, l as l2, l as l3, l as l4, l as l5
    where len(list_distinct([l1.k, l2.k, l3.k, l4.k, l5.k])) = 5),
spots as (select ks, step, ks[step] as own, ks[1:step - 1] as earlier from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
judged as (
    select part, ks, step, own, n, good, toxic, fails[own] = 1 as failing, list_sum(fails) as n_failing,
        coalesce(list_max(list_transform(earlier, lambda x: fails[x])), 0) = 1 as gone
    from cells, spots),
counted as (
    select part, ks, step, own, sum(case when not gone and not failing then n else 0 end) as kept,
        sum(case when not gone and failing then n else 0 end) as removed,
        sum(case when gone and failing then n else 0 end) as redundant,
        sum(case when failing and n_failing = 1 then n else 0 end) as unique_fails,
        sum(case when not gone and failing then good else 0 end) as good_lost,
        sum(case when not gone and failing then toxic else 0 end) as toxic_lost
    from judged group by all)
select part, array_to_string(list_transform(ks, lambda x: substr('ABCDE', x, 1)), '') as filter_order, cast(step as int) as step,
    cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
    cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
    cast(sum(removed) over (partition by part, own) as bigint) as shapley
from counted""",
}

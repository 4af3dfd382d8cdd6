"""Queries of the operators with their production parameters, each over its whole table; ``ORACLE`` has SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.sql import OP12, OP13


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.warc import archived_pages

    return archived_pages(_table(spark, sf_dir, "pages")).drop("digest_holds")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.decontaminate import decontaminate

    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.lm import lm_scores

    return lm_scores(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.quality import quality

    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.packing import packed_sequences

    return packed_sequences(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.line_rules import line_rules

    return line_rules(_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.pfor import token_files

    return token_files(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.merge_automaton import bpe_decode, bpe_encode

    tokenizer = _tokenizer("word_bpe_49k.json")
    done = bpe_decode(bpe_encode(_table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    digest = lambda c: F.sha2(c, 256)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), digest(F.col("text")).alias("decoded_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.spelling import spelling_variants

    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickloom.llm.turn_trie import turn_trie

    return turn_trie(_table(spark, sf_dir, "conversations"))


_OP1 = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
q as (select page_id, octet_length(body)::bigint as payload_bytes, sha1(body) as payload_digest from p),
f as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as top from q)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from f
"""

_OP3 = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
ii as (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from iw where len(w) > 0),
win as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as g from ii),
sizes as (select distinct n from win),
dp as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, sizes where len(w) >= n),
hit as (select d.doc_id, d.i, d.n, win.item_id from (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g from dp) d join win on win.n = d.n and win.g = d.g),
spots as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hit)) group by 1),
names as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item_id::varchar as item from hit) group by 1)
select dw.doc_id, len(dw.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join spots using (doc_id) left join names using (doc_id)
"""


def _op8() -> str:
    from tickloom.llm import line_rules as r

    word = r"'[^\x20\x09-\x0D]+'"

    def count(text: str, chars: str) -> str:
        return f"(length({text}) - length(translate({text}, '{chars}', '')))"

    free = "".join(f"{a}-{b}" for a, b in r.UNPUNCTUATED)
    return f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
d as (select doc_id, text, regexp_extract_all(text, {word}) as w from t),
wi as (select doc_id, array_to_string(w[i:i + {r.RUN - 1}], ' ') as g, i from (select doc_id, w, unnest(range(1, len(w) - {r.RUN} + 2)) as i from d where len(w) >= {r.RUN})),
rp as (select doc_id, unnest(range(i, i + {r.RUN})) as p from (select *, count(*) over (partition by doc_id, g) as c from wi) where c > 1),
rc as (select doc_id, count(distinct p) as n from rp group by 1),
ln as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
lw as (select doc_id, line, regexp_extract_all(line, {word}) as w from ln),
ls as (select doc_id, line, len(w) as n, length(array_to_string(w, '')) as chars from lw where len(w) > 0),
lf as (select *, {count("line", r.SEPARATORS)} >= {r.BARS} or (length(line) - length(replace(line, '!!', ''))) >= {2 * r.SHOUTS}
  or 100 * {count("line", r.SYMBOLS)} > {r.SYMBOL_PERCENT} * chars or (n >= {r.BARE_WORDS} and not regexp_matches(line, '[{r.PUNCTUATION}{free}]'))
  or regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{r.BOILERPLATE}') as fails from ls),
la as (select doc_id, count(*) - count(distinct line) as dup, coalesce(sum(chars) filter (fails), 0) as lost, sum(chars) as total from lf group by 1),
b as (select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, {count("text", r.SYMBOLS)}::bigint as n_symbols, coalesce(dup, 0)::bigint as n_dup_lines, coalesce(rc.n, 0)::bigint as n_repeat_words, coalesce(lost, 0) as lost, coalesce(total, 0) as total
  from d left join rc using (doc_id) left join la using (doc_id)),
f as (select *, n_words < {r.LEAST_WORDS} or 100 * n_repeat_words > {r.REPEAT_PERCENT} * n_words as base_failed from b)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and 100 * lost <= {r.LOST_PERCENT} * total as kept from f
"""


QUERIES = {f.__name__: f for f in (op1_warc, op2_token_counts, op3_decontaminate, op4_lm_scores, op5_simhash, op6_quality, op7_packing, op8_line_rules, op9_token_files, op10_toxicity, op11_bpe, op12_spelling, op13_turn_trie)}
ORACLE = {"op1_warc": _OP1, "op3_decontaminate": _OP3, "op8_line_rules": _op8(), "op12_spelling": OP12, "op13_turn_trie": OP13}

"""The registered queries of this package, and their DuckDB SQL where it has any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ludica.llm import (byte_bpe, decontaminate, language_id, lexical_search, pii, quality_rules, simhash, token_counts,
                        token_output, tool_calls, toxicity, url_filter, whitening)
from ludica.llm.common import read_table

#: Appended to every document of the token files.
END_ID = 2


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, bit-packed to files and read back."""
    return token_output.read_digests(token_output.tokenize_to_files(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID, added_tokens=True))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and the compression verdict of all documents."""
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of all conversations as linked, ordered and validated calls."""
    return tool_calls.link_calls(*tool_calls.calls_of_conversations(read_table(spark, sf_dir, "conversations")),
                                 tool_calls.TURN_SCHEMAS)


def op4_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents."""
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op5_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram piece counts of all documents."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and language spans of all documents."""
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    labelled = spark.createDataFrame(url_filter.LABELLED, "url string, label int")
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), url_filter.train(labelled))


def op8_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores and offending sentences of all documents."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents, decoded again, as digests."""
    tokens = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), tokens, public_tokenizers.PATTERN)
    return byte_bpe.digests(encoded, tokens)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items that they contain."""
    return decontaminate.contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                            short_items=True)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All finite embeddings on the whitened principal components, a row for each component."""
    return whitening.component_rows(read_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that rank highest for each benchmark item."""
    return lexical_search.top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digests(pii.find_spans(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_compression_bands, op3_tool_call_linking, op4_simhash_pigeonring,
                            op5_viterbi_counts, op6_language_spans, op7_url_filter, op8_toxicity_mil, op9_byte_bpe,
                            op10_decontaminate, op11_whitening, op12_lexical_search, op13_pii)}

ORACLE: dict[str, str] = {
    "op13_pii": r"""
        WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
        p(name, kind_at, pattern, words) AS (VALUES
          ('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', 'mail|contact|kontakt|correo|courriel|write|schreib|escrib'),
          ('ip', 1, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+', '[^a-z]ip[^a-z]|address|server|host|adresse|direcci'),
          ('card', 2, '[0-9](?:[ -]?[0-9])+', 'card|credit|visa|mastercard|karte|tarjeta|carte'),
          ('phone', 3, '\+[0-9][ ().0-9-]+[0-9]',
           'phone|call|tel[^a-z]|fax|mobile|telefon|teléfono|téléphone|anruf|llam|appel'),
          ('dotted', 2, '\b[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}\b', 'card|credit|visa|mastercard|karte|tarjeta|carte'),
          ('national', 3, '\b0[0-9]{1,4}[ /.-][0-9]{3,4}(?:[ .-]?[0-9]{2,4}){1,3}\b',
           'phone|call|tel[^a-z]|fax|mobile|telefon|teléfono|téléphone|anruf|llam|appel'),
          ('iban', 4, '\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b', 'iban|account|konto|cuenta|compte|bank|banque|banco'),
          ('ssn', 5, '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b',
           'ssn|social security|sozialversicherung|seguridad social|sécurité sociale')),
        parts AS (
          SELECT doc, name, kind_at, words, regexp_extract_all(text, pattern) AS hits, regexp_split_to_array(text, pattern) AS gaps
          FROM d, p),
        hits AS (
          SELECT doc, name, kind_at, words, unnest(generate_series(1, len(hits))) AS i, unnest(hits) AS hit,
                 unnest(gaps[1:len(hits)]) AS gap, unnest(gaps[2:len(hits) + 1]) AS following
          FROM parts WHERE len(hits) > 0),
        placed AS (
          SELECT *, (sum(len(gap) + len(hit)) OVER (PARTITION BY doc, name ORDER BY i) - len(hit))::BIGINT AS begins,
                 regexp_replace(hit, '[^0-9]', '', 'g') AS digits
          FROM hits),
        lengths(country, size) AS (VALUES @LENGTHS@),
        cut AS (
          SELECT h.*, l.size,
                 CASE WHEN name <> 'iban' THEN hit ELSE left(hit, coalesce(list_filter(generate_series(1, len(hit)), lambda n:
                   len(replace(left(hit, n), ' ', '')) = l.size AND (n = len(hit) OR substr(hit, n + 1, 1) = ' '))[1], len(hit))) END AS value
          FROM placed h LEFT JOIN lengths l ON name = 'iban' AND l.country = left(hit, 2)),
        checked AS (
          SELECT *, CASE
              WHEN name = 'ip' THEN len(list_filter(string_split(hit, '.'), lambda x: try_cast(x AS HUGEINT) <= 255)) = 4
              WHEN name IN ('card', 'dotted') THEN len(digits) BETWEEN 12 AND 19 AND
                list_sum(list_transform(string_split(reverse(digits), ''), lambda c, n:
                  CASE WHEN n % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END)) % 10 = 0
              WHEN name = 'phone' THEN len(digits) BETWEEN 9 AND 15
              WHEN name = 'national' THEN len(digits) BETWEEN 9 AND 12
              WHEN name = 'iban' THEN coalesce(len(replace(value, ' ', '')) = size AND
                list_reduce(list_prepend(0, list_transform(string_split(
                  substr(replace(value, ' ', ''), 5) || left(replace(value, ' ', ''), 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END)),
                  lambda a, b: (a * (CASE WHEN b < 10 THEN 10 ELSE 100 END) + b) % 97) = 1, false)
              WHEN name = 'ssn' THEN NOT regexp_matches(hit, '^000|^666|^9|-00-|-0000$')
              ELSE true END AS ok,
            regexp_matches(right(gap, 50), '(?:' || words || ')', 'i') OR regexp_matches(left(following, 20), '(?:' || words || ')', 'i') AS near
          FROM cut),
        spans AS (
          SELECT doc, kind_at, begins, begins + len(value) AS ends, name IN ('email', 'ip', 'card', 'phone') AS base
          FROM checked
          WHERE CASE WHEN name IN ('email', 'ip', 'card', 'phone') THEN ok
                ELSE 3 + CASE WHEN NOT ok THEN 0 WHEN name IN ('dotted', 'iban') THEN 4 ELSE 1 END
                     + CASE WHEN near THEN 3 ELSE 0 END >= 6.5 END),
        kept AS (
          SELECT s.* FROM spans s WHERE s.base OR NOT EXISTS (
            SELECT 1 FROM spans b WHERE b.base AND b.doc = s.doc AND b.begins < s.ends AND s.begins < b.ends)),
        named AS (SELECT *, ['email', 'ip', 'card', 'phone', 'iban', 'ssn'][kind_at + 1] || ':' || begins || ':' || ends AS span FROM kept),
        lists AS (
          SELECT doc, count(*) FILTER (base AND kind_at = 0) AS n_email, count(*) FILTER (base AND kind_at = 1) AS n_ip,
                 count(*) FILTER (base AND kind_at = 2) AS n_card, count(*) FILTER (base AND kind_at = 3) AS n_phone,
                 string_agg(span, ',' ORDER BY begins, kind_at, ends) FILTER (base) AS base,
                 string_agg(span, ',' ORDER BY begins, kind_at, ends) AS spans
          FROM named GROUP BY doc)
        SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
               coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN lists USING (doc)""".replace("@LENGTHS@", ", ".join(f"('{c}', {n})" for c, n in pii.IBAN_LENGTHS.items())),
    "op12_lexical_search": r"""
        WITH words AS (
          SELECT row_number() OVER () AS doc, doc_id,
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
          FROM documents WHERE text IS NOT NULL),
        sized AS (SELECT doc, doc_id, terms, len(terms) AS n FROM words WHERE len(terms) > 0),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sized),
        normed AS (SELECT doc, doc_id, 50 + (50 * n * t.docs) // t.terms AS m FROM sized, total t),
        counts AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized) GROUP BY doc, term),
        weights AS (
          SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(t.docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
          FROM counts, total t GROUP BY term),
        items AS (
          SELECT DISTINCT item_id, unnest(
                 regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark),
        scored AS (
          SELECT i.item_id, d.doc_id, d.doc, sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * d.m)))::BIGINT AS score
          FROM items i JOIN weights w USING (term) JOIN counts c USING (term) JOIN normed d USING (doc)
          GROUP BY i.item_id, d.doc_id, d.doc),
        ranked AS (
          SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
                 doc_id, score
          FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
    "op3_tool_call_linking": """
        WITH RECURSIVE calls AS (
          SELECT conv_id, turn, coalesce(conv_id::VARCHAR, '') || ':' || turn::VARCHAR AS call_id, text,
                 CASE role WHEN 'user' THEN 'reply' WHEN 'system' THEN 'instruct' ELSE coalesce(role, 'unknown') END AS name
          FROM conversations WHERE role IS DISTINCT FROM 'assistant'),
        one AS (
          SELECT call_id, min(conv_id) AS group_id, min(turn) AS position, arg_min(text, (turn, name, text)) AS text,
                 min(name) AS name, count(*) AS n_calls
          FROM calls WHERE call_id IS NOT NULL GROUP BY call_id),
        answers AS (
          SELECT coalesce(conv_id::VARCHAR, '') || ':' || (turn - 1)::VARCHAR AS call_id,
                 arg_min(text, (turn, text)) AS content, count(*) AS n_results
          FROM conversations WHERE role = 'assistant' AND turn IS NOT NULL GROUP BY 1),
        wants AS (
          SELECT call_id, group_id, position, unnest(CASE
                   WHEN group_id % 2 = 0 THEN [2 * (2 * (position // 2) + 1) + position % 2, 2 * (2 * (position // 2) + 2) + position % 2]
                   WHEN position >= 2 THEN [position - 2] ELSE [] END) AS dep_position
          FROM one),
        edges AS (
          SELECT w.*, d.call_id AS dep
          FROM wants w LEFT JOIN one d ON d.call_id = coalesce(w.group_id::VARCHAR, '') || ':' || w.dep_position::VARCHAR),
        missing AS (SELECT call_id, count(*) AS n_missing FROM edges WHERE dep IS NULL GROUP BY 1),
        forward AS (SELECT DISTINCT group_id FROM edges WHERE dep IS NOT NULL AND dep_position >= position),
        steps(call_id, level) AS (
          SELECT call_id, 0 FROM one WHERE call_id NOT IN (SELECT call_id FROM edges WHERE dep IS NOT NULL)
          UNION
          SELECT e.call_id, s.level + 1 FROM steps s JOIN edges e ON e.dep = s.call_id JOIN forward f ON f.group_id = e.group_id),
        levels AS (SELECT call_id, max(level) AS level FROM steps GROUP BY 1),
        checked AS (
          SELECT *, CASE WHEN name NOT IN ('reply', 'instruct') THEN 'no schema' WHEN text IS NULL THEN '$.text: missing'
                         WHEN text = '' THEN '$.text: length 0'
                         WHEN name = 'instruct' AND position <> 0 THEN '$.turn: not one of the values'
                         WHEN position < 0 THEN '$.turn: out of range' END AS wrong
          FROM one)
        SELECT o.group_id, coalesce(o.call_id, a.call_id) AS call_id, o.position,
               CASE WHEN o.call_id IS NOT NULL THEN coalesce(l.level, 0)::INTEGER END AS level,
               o.name,
               coalesce(o.n_calls, 0)::BIGINT AS n_calls, coalesce(a.n_results, 0)::BIGINT AS n_results,
               coalesce(m.n_missing, 0)::BIGINT AS n_missing,
               CASE WHEN o.call_id IS NULL THEN 'orphan' WHEN a.call_id IS NULL THEN 'open' ELSE 'linked' END AS status,
               (o.call_id IS NOT NULL AND o.wrong IS NULL) AS valid,
               CASE WHEN o.call_id IS NULL THEN 'no call' ELSE o.wrong END AS error,
               '{"arguments":' || CASE WHEN o.call_id IS NULL THEN 'null' ELSE '{' ||
                   CASE WHEN o.text IS NULL THEN '' ELSE '"text":' || to_json(o.text)::VARCHAR || ',' END
                   || '"turn":' || o.position::VARCHAR || '}' END
               || ',"id":' || to_json(coalesce(o.call_id, a.call_id))::VARCHAR
               || ',"name":' || CASE WHEN o.call_id IS NULL THEN 'null' ELSE to_json(o.name)::VARCHAR END
               || ',"result":' || coalesce(to_json(a.content)::VARCHAR, 'null') || '}' AS json
        FROM checked o FULL JOIN answers a ON o.call_id = a.call_id LEFT JOIN missing m ON m.call_id = o.call_id
          LEFT JOIN levels l ON l.call_id = o.call_id""",
}

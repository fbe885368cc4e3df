"""Types of the corpus: papers, their sections, hits, works, runs. The last two columns of a paper serve the search language."""

from __future__ import annotations

from pyspark.sql import types as T

SECTIONS = "array<struct<pos:int,name:string,content:string>>"
_NAMED = "struct<id:string,display_name:string>"
_TOPIC = f"struct<id:string,display_name:string,score:double,subfield:{_NAMED},field:{_NAMED},domain:{_NAMED}>"

PAPER_DDL = f"""pmid string, pmcid string, doi string, title string, abstract string, full_text string, full_text_sections {SECTIONS},
mesh_terms array<string>, keywords array<string>, authors array<string>, year string, date_published string, journal string,
is_full_text_pmc boolean, oa_url string, primary_topic {_TOPIC}, topic_name string, topic_subfield string, topic_field string, topic_domain string,
citation_normalized_percentile double, cited_by_count bigint, fwci double, collection_date string, openalex_retrieved boolean,
query_id bigint, source string, parsing_status string, embedding binary, yake_keywords string,
publication_type string, mesh_major array<string>"""
QUERIES_DDL = "id bigint, query_text string, description string, created_date string"
RUNS_DDL = """id bigint, query string, total_found bigint, total_processed bigint, with_full_text bigint,
without_full_text bigint, with_openalex bigint, failed_pubmed bigint, failed_openalex bigint, start_time string, end_time string"""
FAILED_DDL = "doi string, pmid string, reason string, timestamp string"
#: Records that couldn't be read: what they were, why, and their text as it came.
REJECTS_DDL = "digest string, pmid string, kind string, reason string, record string, timestamp string"
CACHE_DDL = "query_hash string, query string, pmids array<string>, count int, max_results int, cached_date string"


def paper() -> T.StructType:
    return T.StructType.fromDDL(PAPER_DDL)

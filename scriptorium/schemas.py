"""Declared schemas of files and of the graph."""

from __future__ import annotations

FRONTMATTER = "map<string,string>"
MANIFEST = "source string, sermon_id string, title string, date string, year int, location string, duration string, pdf_url string, source_path string, aliases array<string>, file_hash string, size_bytes bigint"
WORK = "id string, kind string, source string, source_id string, lang string, title string, subtitle string, slug string, summary string, date string, year int, duration_min int, llm_cleaned boolean, content_hash string"
REF = "id string, book string, chapter int, verse_start int, verse_end int, canonical string"
EMBEDDING_CACHE = "content_hash string, model string, dim int, vector array<float>"
KINDS = ("sermon", "exhortation", "bible_study", "article", "book", "chapter")
BIBLE_JSON = "books array<struct<nr:int,chapters:array<struct<chapter:int,verses:array<struct<verse:int,text:string>>>>>>"
CMS = "db array<struct<data:struct<posts:array<struct<id:string,title:string,slug:string,html:string,status:string,type:string,published_at:string,updated_at:string>>,tags:array<struct<id:string,name:string,slug:string,visibility:string>>,users:array<struct<id:string,name:string>>,posts_tags:array<struct<post_id:string,tag_id:string,sort_order:int>>,posts_authors:array<struct<post_id:string,author_id:string,sort_order:int>>>>>"
LLM_ANSWER = "title string, subtitle string, date string, location string, preacher string, summary string, tags array<string>, persons array<string>, places array<string>, themes array<string>, cleaned_markdown string, _meta struct<model:string,chunks:int,prompt_tokens:bigint,completion_tokens:bigint,cached_tokens:bigint>, _error string, _parse_error string"

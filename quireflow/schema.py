"""Explicit types of the nested documents; nothing is inferred."""

from __future__ import annotations

REF = "book:string,chapter:string,verse:string"
SOURCE = f"struct<{REF},quoted_text:string,scope:string>"
ANSWER = f"struct<answer_text:string,source_refs:array<struct<{REF}>>,is_primary:boolean>"
SUBQUESTION = f"struct<subquestion_id:string,label:string,prompt:string,points:int,answer_length:string,acceptable_answers:array<{ANSWER}>,requires_free_text_judging:boolean>"
OPTION = "struct<key:string,text:string>"
UNIT = (
    "struct<unit_id:string,display_number:string,narrative_context:string,prompt:string,question_type:string,answer_style:string,"
    f"options:array<{OPTION}>,correct_option:string,subquestions:array<{SUBQUESTION}>,primary_sources:array<{SOURCE}>,scoring:struct<points:int>,"
    f"acceptable_answers:array<{ANSWER}>,media_attachments:string,localizations:string,format_confidence_note:string>"
)
RULES = "struct<points_per_correct:int,points_decay_per_hint:int,time_limit_seconds:int>"
SECTION = f"struct<section_id:string,section_title:string,section_epigraph:string,stage_subtype:string,track:string,live_stage_rules:{RULES},question_units:array<{UNIT}>>"
CREDITS = "struct<program_supervisor:string,quiz_coordinator:string,question_authors:array<string>,editor:string,committee_members:array<string>>"
METADATA = (
    "struct<contest_year_civil:int,contest_year_hebrew:string,track:string,stage:string,sitting:string,age_group:string,annual_theme:string,"
    f"credits:{CREDITS},syllabus:array<struct<book:string,chapters:string>>,time_limit_minutes:int,instructions_text:string,source_text_edition:string,"
    "scoring_summary:struct<points_per_question:int,max_points:int,scoring_is_tiered:boolean>>"
)
PROVENANCE = "struct<fetched_from:string,fetch_date:string,extraction_quality:string,extraction_notes:string>"
DOCUMENT = (
    f"questionnaire_id string, source_url string, metadata {METADATA}, sections array<{SECTION}>, answer_key_present boolean, "
    f"answer_key_location string, answer_key_source string, import_provenance {PROVENANCE}"
)
VERSE = "book string, chapter int, verse int, ref string, niqqud string, text_with_niqqud string"
LINE = "doc_id string, page_no int, line_no int, line string"
EMPHASIS = "array<struct<line:string,spans:array<struct<text:string,bold:boolean,underline:boolean>>>>"
SCHEMA_VERSION = "1.0"

"""Row types of the stages, as Spark DDL. Every reader takes one of these; nothing is inferred."""

SUPPORT = "struct<records:bigint,institutions:bigint,count:bigint>"
PROVENANCE = "struct<institution:string,url:string,section:string,fetched_at:timestamp>"
META = "struct<language:string,charset:string,hints:map<string,string>>"
RATIONALE = "struct<passed_gates:map<string,boolean>,reasons:array<string>,thresholds:map<string,double>>"
SOURCE_RECORD = f"text string, provenance {PROVENANCE}, meta {META}"
SNAPSHOT_META = "struct<rendered:boolean,robots_blocked:boolean,alias_urls:array<string>,redirects:array<string>,source:string>"
SNAPSHOT = f"institution string, url string, canonical_url string, fetched_at timestamp, http_status int, content_type string, html string, text string, lang string, checksum string, meta {SNAPSHOT_META}"
CANDIDATE_FIELDS = f"level int, label string, normalized string, parents array<string>, aliases array<string>, variants array<string>, observed_forms array<string>, support {SUPPORT}"
CANDIDATE = f"struct<level:int,label:string,normalized:string,parents:array<string>,aliases:array<string>,variants:array<string>,observed_forms:array<string>,support:{SUPPORT}>"
EVIDENCE = f"candidate {CANDIDATE}, institutions array<string>, record_fingerprints array<string>"
DECISION = f"{EVIDENCE}, rationale {RATIONALE}, weight double, passed boolean"
CONCEPT = f"id string, level int, canonical_label string, parents array<string>, aliases array<string>, variants array<string>, observed_forms array<string>, support {SUPPORT}, rationale {RATIONALE}, validation_passed boolean, validation_metadata string"
FINDING = "concept_id string, mode string, passed boolean, detail string, evidence string"
MERGE_OP = "operation_id string, winners array<string>, losers array<string>, rule string, evidence string, performed_at timestamp"
SPLIT_OP = "operation_id string, source_id string, new_ids array<string>, rule string, evidence string, performed_at timestamp"
CONTEXT = "concept_id string, text string, institution string, parent_lineage string, source_index int, metadata map<string,string>"

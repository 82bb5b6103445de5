"""Vocabularies, patterns and tables that results depend on."""

from __future__ import annotations

CONCEPT_TYPES = "person group organization place object term method theme motif time_anchor emotion social_role institution symbol scene_element technical_component dataset metric source other".split()
ITEM_TYPES = "event scene action claim argument statement observation description method technique result limitation habit question unresolved_issue definition example comparison contrast background note other".split()
GROUP_TYPES = "timeline temporal_sequence theme_set concept_map discourse_graph claim_evidence_map viewpoint_evolution open_thread_list method_example_set motif_development contrast_set other".split()
EDGE_TYPES = "mentions refers_to aliases same_as_candidate part_of elaborates supports contradicts qualifies contrasts causes enables explains follows_from precedes continues resolves raises_question answers_question exemplifies defines uses_method produces_result has_limitation related_to other".split()
PROVENANCE = "source_grounded synthesis deterministic llm_inferred user_corrected".split()
DELTA_OPERATIONS = "new_concept alias_candidate merge_proposal summary_update logical_group_continuation cross_unit_link ambiguity_item user_review_needed".split()

#: Noisy concept types and the coarse type each stands for.
TYPE_ALIASES = {
    "thing": "object",
    "substance": "object",
    "format": "object",
    "component": "technical_component",
    "technical_component": "technical_component",
    "work": "source",
    "collection": "source",
    "source_statement": "source",
    "condition": "theme",
    "phenomenon": "theme",
    "event_type": "theme",
    "concept": "theme",
    "role": "social_role",
    "relationship": "social_role",
}

#: Types that may name the same thing; any other type is a family by itself, and ``other`` matches all.
TYPE_FAMILIES = {
    "person": ["person", "group", "organization", "social_role"],
    "group": ["person", "group", "organization"],
    "organization": ["person", "group", "organization", "institution"],
    "institution": ["organization", "institution"],
    "place": ["place", "scene_element"],
    "scene_element": ["place", "scene_element"],
}

#: Words whose period does not end a sentence.
ABBREVIATIONS = frozenset(
    "dr mr mrs ms prof rev hon jr sr vs etc approx dept est govt ie eg am pm st ave blvd rd vol ch p pp no nos al cf ed eds et fig figs ibid id loc op seq sq ss v capt col gen lt maj sgt".split()
)

#: Elements that begin and end a line when a page is flattened.
BLOCK_TAGS = frozenset(
    "address article aside blockquote br dd div dl dt figcaption figure footer h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split()
)

_NUMERALS = "0-9零〇○一二三四五六七八九十百千万兩两壹贰貳叁參肆伍陆陸柒捌玖拾佰仟"
#: Heading patterns in order: pattern of the whole line, with the label as its first group, and the kind.
HEADINGS = [
    (r"(?i)^((?:part|book|chapter)\s+(?:[0-9]+|[ivxlcdm]+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve))[\s:.-]*$", "chapter"),
    (r"(?i)^(prologue|epilogue|preface|introduction)[\s:.-]*$", "section"),
    (rf"^(第[{_NUMERALS}]+[部卷章节節回篇集](?:[\s　]+.+)?)\s*$", "chapter"),
    (rf"^(卷[{_NUMERALS}]+(?:[\s　]+.+)?)\s*$", "chapter"),
    (r"^(上篇|中篇|下篇|前言|序|序章|楔子|后记|後記|跋|附录|附錄)[\s：:.-]*$", "section"),
]
HEADING_LEVEL = 2
HEADING_LENGTH = 120
CJK_CHAPTER = rf"^第[{_NUMERALS}]+[章节節回卷部篇集]"

#: Full-width marks and what they are folded to when quotes are located.
FOLD_FROM = "，、。．：；！？（）“”‘’—－"
FOLD_TO = ",,..:;!?()\"\"''--"
#: Marks that the last tier of location drops.
DROPPED_MARKS = "，、。．：；！？（）“”‘’—－《》〈〉「」『』【】[](),.!?;:\"'`"
#: Marks and blanks between the clauses of a quote.
CLAUSE_ENDS = r"[，。！？；：,.!?;:\s]+"
#: Openings of these lengths, of clauses without so many first characters, stand for a missing quote; shorter parts and openings do not.
NEEDLE_LENGTHS = (12, 8, 4)
NEEDLE_PARTS = (0, 2, 4, 6)
LEAST_PART, LEAST_NEEDLE = 4, 2
NOTE_MARKER = r"\[\d{1,4}\]"

#: Longest block, shortest sentence fragment, in characters.
MAX_BLOCK_CHARS = 800
MIN_FRAGMENT_CHARS = 20
SENTENCE_END = "。！？；.!?"
RULE_LINE = r"^\s*(?:[-*_]{3,}|—{2,}|\*[ ]*\*[ ]*\*)\s*$"

#: Code points that count as CJK in the token estimate.
CJK = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{2CEB0}-\x{2EBEF}"
#: Limits of a request, in tokens.
MAX_CONTEXT, MAX_OUTPUT = 850_000, 384_000

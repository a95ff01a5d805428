"""Text cleaning as ordered regular-expression rules, evaluated inside the JVM.

Every cleaner takes and returns a string column; null stays null. Encoding is
repaired first: a text that was decoded as Windows-1252 though it was UTF-8 is
decoded again, up to twice, where all of it fits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns define the results. A leading (?m) means line by line.
BLANKS = [(r"[ \t]+", " ")]
STRUCTURE = [
    (r"\s*---\s*", "\n\n---\n\n"),
    (r"(?<!\n)(#{1,6}\s+(?=\S))", "\n\\1"),
    (r"(?<!\n)(\b\d{1,2}\.\s+(?=\S))", "\n\\1"),
    (r"(?m)^\s*#{1,6}\s*(?:\*+|_+)?\s*$", ""),
    (r"[\x{1F300}-\x{1F9FF}]{3,}", ""),
]
LINES = [(r"\n{3,}", "\n\n"), (r"[\x{200B}-\x{200D}\x{FEFF}]", ""), (r"(\w)-\s+(\w)", "\\1\\2")]
FLAT_QUOTES = [(r"\s*\n\s*", " "), (r'\b"(\w+)"\b', "\\1"), (r'"([^"]+[.,!?])"', "\\1"), (r'"([A-Z][^"]*?)"(?=\s|$)', "\\1")]
ESCAPES = [(r"\\+([\"'])", "\\1")]
STARS = [(r'\*+"', '"'), (r'"\*+', '"'), (r'\*\s*"', ' *"'), (r'"\s*\*', '"* ')]
NINES = [
    (r"(?i)\b([a-z]+)9(?=(?:t|s|m|re|ve|ll|d)\b)", "\\1'"),
    (r"(?i)(?<=in)9(?=\b|[^a-z])", "g"),
    (r"(?i)\b([a-z]{2,})9(?=s\b)", "\\1'"),
    (r"([!?.,]){2,}[\"']", '\\1"'),
    (r"[ \t]{2,}", " "),
    (r"\b9em\b", "em"),
    (r"(?<!\d)9(?!\d)", ""),
]
SCANNED = [(r"\bl\b", "I"), (r"\bO(?=\d)", "0"), (r"(?<=\d)O\b", "0"), (r"\brn\b", "m"), (r"\bvv", "w"), (r"\|", "I"), (r"(\w+)-\s*\n\s*(\w+)", "\\1\\2")]
SPEECH = [(r"[^\w\s.,!?;:'-]", ""), (r"^\s+|\s+$", ""), (r"\n+", ". "), (r"\s+", " "), (r"([.!?])\s*([A-Z])", "\\1 \\2")]
ROLES = "User|Assistant|model|Human|AI"
FAMILY_STOPS = {
    "gemma": ["<end_of_turn>", "<start_of_turn>"],
    "llama": ["<|eot_id|>", "<|start_header_id|>"],
    "qwen": ["<|im_end|>", "<|im_start|>"],
    "chatml": ["<|im_end|>", "<|im_start|>"],
    "deepseek": ["<|im_end|>", "<|im_start|>"],
    "mistral": ["[/INST]", "[INST]", "</s>"],
    "phi": ["<|end|>", "<|user|>", "<|endoftext|>"],
}
FAMILY_MARKS = {
    "llama": [r"<\|end_header_id\|>"],
    "phi": [r"(?s)<\|system\|>.*?<\|end\|>", r"<\|assistant\|>"],
}
RAMBLING = [
    r"\bIn conclusion\b.*$",
    r"\bAs they continue\b.*$",
    r"\bThis helps to deepen\b.*$",
    r"\bBy using appropriate\b.*$",
    r"\bWhether it's a\b.*$",
    r"\bSo let us\b.*$",
    r"\n\n[A-Z][^.!?]*?(education|entertainment|professional|communication|learning|understanding).*$",
]

STRUCTURED_RULES = BLANKS + STRUCTURE + LINES + ESCAPES + NINES
FLAT_RULES = BLANKS + LINES + FLAT_QUOTES + ESCAPES + STARS + NINES


def apply_rules(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Rules in order. Classes and word borders follow Unicode, lines end at newlines only."""
    for pattern, to in rules:
        text = F.regexp_replace(text, F.lit("(?Ud)" + pattern), F.lit(to.replace("$", r"\$").replace("\\1", "$1").replace("\\2", "$2")))
    return text


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


# The characters that Windows-1252 has at the bytes from 0x80 to 0x9F that it uses.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("latin-1")


def repair_encoding(text: Column, rounds: int = 2) -> Column:
    """The text as it was before UTF-8 was read as Windows-1252; texts in which not every character fits that stay as they are."""
    for _ in range(rounds):
        raw = F.translate(text, CP1252, CP1252_BYTES)
        suspect = raw.rlike(r"[\xC2-\xF4][\x80-\xBF]") & raw.rlike(r"\A[\x00-\xFF]*\z")
        again = F.try_validate_utf8(F.encode(F.when(suspect, raw), "ISO-8859-1").cast("string"))
        text = F.coalesce(again, text)
    return text


def clean_structured(text: Column) -> Column:
    """Keeps headings, lists and rules as lines of their own."""
    return strip(apply_rules(repair_encoding(text), STRUCTURED_RULES))


def clean_flat(text: Column) -> Column:
    """One paragraph without quote and star artefacts."""
    return strip(apply_rules(repair_encoding(text), FLAT_RULES))


def drop_repeated_lines(text: Column, most: int = 3) -> Column:
    """Without lines that occur more than ``most`` times; blank lines stay. Sorts the lines, so time stays near linear."""
    lines = F.split(text, "\n")
    # A line occurs too often if it meets itself ``most`` places on in sorted order.
    often = F.transform(F.array(F.array_sort(lines)), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i + most) == x)))
    return F.array_join(F.flatten(F.transform(often, lambda o: F.filter(lines, lambda x: (strip(x) == "") | ~F.array_contains(o, x)))), "\n")


def clean_scanned(text: Column) -> Column:
    """Letters that scanning confuses, hyphenated lines, repeated lines, then the flat rules."""
    return clean_flat(drop_repeated_lines(apply_rules(text, SCANNED)))


def clean_speech(text: Column) -> Column:
    """Words and sentence marks only; line breaks become sentence ends."""
    return apply_rules(text, SPEECH)


def clean_response(text: Column, family: str = "chatml", show_reasoning: bool = False) -> Column:
    """A model's answer up to the first of its family's stop strings, without marks, reasoning (or with it in front), role prefixes and role lines; of phi without rambling."""
    for stop in FAMILY_STOPS.get(family, FAMILY_STOPS["chatml"]):
        text = F.substring_index(text, stop, 1)
    for pattern in FAMILY_MARKS.get(family, []):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(""))
    think = r"(?s)<think>(.*?)</think>"
    blocks = F.transform(F.regexp_extract_all(text, F.lit(think), 1), lambda b: F.concat(F.lit("💭 **Reasoning:**\n"), strip(b)))
    answer = F.regexp_replace(text, think, "")
    if show_reasoning:
        answer = F.when(F.size(blocks) > 0, F.concat(F.array_join(blocks, "\n\n"), F.lit("\n\n**Answer:**\n"), strip(answer))).otherwise(answer)
    rules = [(rf"(?i)\A({ROLES}):\s*", ""), (rf"(?im)\n({ROLES}):\s*.*$", ""), (r"\n{3,}", "\n\n"), (r" {2,}", " ")]
    answer = apply_rules(strip(answer), rules)
    if family == "phi":
        for pattern in RAMBLING:
            answer = F.regexp_replace(answer, F.lit("(?Uis)" + pattern), F.lit(""))
        # A long answer to a choice of letters ends after the letter's line, if much follows.
        choice = F.regexp_extract(answer, r"(?m)^((?s:.*?)\b[A-F]\.\s*[^\n]+)", 1)
        rest = strip(F.substring(answer, F.length(choice) + 1, F.length(answer)))
        answer = F.when((F.length(answer) > 500) & (choice != "") & answer.startswith(choice) & (F.length(rest) > 200), strip(choice)).otherwise(answer)
    return strip(answer)

"""Column expressions. Everything here stays in the JVM: no Python workers."""

from pagevane.functions.html import extract_text, first_h1, main_text, unescape
from pagevane.functions.language import detect_lang
from pagevane.functions.segment import segment_text, sentence_split, word_count
from pagevane.functions.text import local_key, resolve_path, strip, tokens
from pagevane.functions.vectors import dot, l2_norm, l2_normalize, token_code

__all__ = [
    "detect_lang",
    "dot",
    "extract_text",
    "first_h1",
    "l2_norm",
    "l2_normalize",
    "local_key",
    "main_text",
    "resolve_path",
    "segment_text",
    "sentence_split",
    "strip",
    "token_code",
    "tokens",
    "unescape",
    "word_count",
]

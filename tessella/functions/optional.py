"""What needs libraries that may be absent: OCR, page rasters, Punkt sentences and model tokenizers.

Each returns what says "nothing" where its library or data can't be had, and callers fall back.
"""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_tokenizers: dict[str, object] = {}


def ocr_text(png: bytes | None, psm: int = 6) -> str:
    """The text in an image; empty without the OCR libraries or if they fail."""
    try:
        import pytesseract
        from PIL import Image

        return pytesseract.image_to_string(Image.open(io.BytesIO(png)), config=f"--psm {psm}")
    except Exception:  # any failure means no text
        return ""


def page_png(data: bytes | None, page: int, clip: tuple[float, float, float, float] | None = None, dpi: int = 300) -> bytes | None:
    """A page of a PDF, or the part of it inside ``clip``, as PNG; None without the library or if it fails."""
    try:
        import fitz

        with fitz.open(stream=data, filetype="pdf") as document:
            zoom = fitz.Matrix(dpi / 72, dpi / 72)
            more = {"clip": fitz.Rect(*clip)} if clip else {}
            return document.load_page(int(page)).get_pixmap(matrix=zoom, alpha=False, **more).tobytes("png")
    except Exception:
        return None


def punkt_sentences(text: str | None) -> list[str] | None:
    """Sentences by the Punkt model; None without it."""
    try:
        import nltk

        return nltk.sent_tokenize(text or "")
    except Exception:
        return None


def model_tokens(text: str | None, name: str) -> int | None:
    """Tokens of a model's tokenizer, without special ones; None if it can't be had."""
    if name not in _tokenizers:
        try:
            from transformers import AutoTokenizer

            _tokenizers[name] = AutoTokenizer.from_pretrained(name)
        except Exception:
            _tokenizers[name] = None
    found = _tokenizers[name]
    return None if found is None else len(found.encode(text or "", add_special_tokens=False))


def ocr(png: Column, psm: int = 6) -> Column:
    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda x: ocr_text(x, psm))

    return run(png)


def rasters(content: Column, page: Column, clip: tuple[float, float, float, float] | None = None, dpi: int = 300) -> Column:
    @F.pandas_udf("binary")
    def run(c: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([page_png(x, i, clip, dpi) for x, i in zip(c, k, strict=True)], dtype=object)

    return run(content, page)


def punkt(text: Column) -> Column:
    @F.pandas_udf("array<string>")
    def run(c: pd.Series) -> pd.Series:
        return c.map(punkt_sentences)

    return run(text)


def tokens_by_model(text: Column, name: str) -> Column:
    @F.pandas_udf("int")
    def run(c: pd.Series) -> pd.Series:
        return pd.Series([model_tokens(x, name) for x in c], dtype="Int32")

    return run(text)

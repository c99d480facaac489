"""Recognised text: a provider's interface, preparation of images, the rule that merges it with a page's own text, and
the pass over flagged pages and images."""

from __future__ import annotations

import io
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdoc.functions.text import normalize_whitespace, strip

#: Pages of one file that a task recognises with one copy of its bytes; times by which a page is enlarged.
PAGES, SCALE = 16, 2.0


@dataclass(frozen=True)
class OcrResult:
    text: str = ""
    confidence: float = 0.0
    provider_id: str = ""
    error: str | None = None
    page_number: int = 1

    @property
    def word_count(self) -> int:
        return len(self.text.split())


class OcrProvider(Protocol):
    """What recognises text: an image's bytes, or a page of a PDF file."""

    provider_id: str

    def is_available(self) -> bool: ...

    def read_image(self, image: bytes, language: str = "eng") -> OcrResult: ...

    def read_pdf_page(self, pdf: bytes, page_number: int, language: str = "eng") -> OcrResult: ...

    def read_batch(self, images: list[bytes], language: str = "eng") -> list[OcrResult]: ...


class NoProvider:
    """Stands in where no provider is installed; what a provider need not write itself."""

    provider_id = "none"

    def is_available(self) -> bool:
        return False

    def read_image(self, image: bytes, language: str = "eng") -> OcrResult:
        return OcrResult(provider_id=self.provider_id, error="provider unavailable")

    def read_pdf_page(self, pdf: bytes, page_number: int, language: str = "eng") -> OcrResult:
        """The page drawn as an image, read as one."""
        return replace(self.read_image(page_image(pdf, page_number), language), page_number=page_number)

    def read_batch(self, images: list[bytes], language: str = "eng") -> list[OcrResult]:
        """One after another, in order, numbered from 1."""
        return [replace(self.read_image(x, language), page_number=i) for i, x in enumerate(images, 1)]


class CloudProvider(NoProvider):
    """A place for a remote service: never available, and reading is an error."""

    provider_id = "cloud"

    def read_image(self, image: bytes, language: str = "eng") -> OcrResult:
        raise NotImplementedError("no remote provider is configured")


def page_image(pdf: bytes, page_number: int, scale: float = SCALE) -> bytes:
    """A page (from 1) drawn at scale as PNG, where PyMuPDF is installed."""
    import fitz

    with fitz.open(stream=pdf, filetype="pdf") as doc:
        return doc.load_page(page_number - 1).get_pixmap(matrix=fitz.Matrix(scale, scale), alpha=False).tobytes("png")


@dataclass(frozen=True)
class Preparation:
    """Steps before recognition, in this order: grey, contrast, median, threshold, turning upright."""

    grey: bool = True
    contrast: bool = True
    median_radius: int = 1
    threshold: int | None = 135
    upright: bool = False


def prepare(img, steps: Preparation = Preparation()):
    """A Pillow image made ready for recognition."""
    from PIL import ImageFilter, ImageOps

    img = img.convert("RGB")
    if steps.grey:
        img = ImageOps.grayscale(img)
    if steps.contrast:
        img = ImageOps.autocontrast(img, cutoff=1)
    if steps.median_radius > 0:
        img = img.filter(ImageFilter.MedianFilter(max(3, 2 * steps.median_radius + 1)))
    if steps.threshold is not None:
        img = img.convert("L").point(lambda p: 255 if p > steps.threshold else 0)
    img = img.convert("RGB")
    return upright(img) if steps.upright else img


def turn_of(report: str) -> int:
    """The angle by which an orientation report says to turn an image."""
    m = re.search(r"Rotate:\s*(\d+)", report)
    return int(m[1]) % 360 if m else 0


def upright(img):
    """The image turned as Tesseract's orientation data say; as it is without them."""
    try:
        import pytesseract

        angle = turn_of(pytesseract.image_to_osd(img, lang="osd"))
    except Exception:
        return img
    return img.rotate(angle, expand=True, fillcolor="white") if angle else img


class TesseractProvider(NoProvider):
    """Tesseract through pytesseract and Pillow, where they are installed."""

    provider_id = "tesseract"

    def __init__(self, steps: Preparation = Preparation()):
        self.steps = steps

    def is_available(self) -> bool:
        try:
            import pytesseract

            pytesseract.get_tesseract_version()
        except Exception:
            return False
        return True

    def read_image(self, image: bytes, language: str = "eng") -> OcrResult:
        if not self.is_available():
            return OcrResult(provider_id=self.provider_id, error="tesseract is not available")
        import pytesseract
        from PIL import Image

        try:
            img = Image.open(io.BytesIO(image))
            img.load()
        except Exception as e:
            return OcrResult(provider_id=self.provider_id, error=f"decode_failed: {e}")
        try:
            img = prepare(img, self.steps)
            text = pytesseract.image_to_string(img, lang=language)
        except Exception as e:
            return OcrResult(provider_id=self.provider_id, error=str(e))
        try:
            confidence = mean_confidence(pytesseract.image_to_data(img, lang=language, output_type=pytesseract.Output.DICT)["conf"])
        except Exception:
            confidence = UNKNOWN_CONFIDENCE
        return OcrResult(text.strip(), confidence, self.provider_id)


# Fixed value: the confidence of text whose words' confidences can't be read.
UNKNOWN_CONFIDENCE = 0.7


def mean_confidence(values) -> float:
    """The mean of whole-number word confidences, from 0 to 1; 0.5 without any."""
    found = [int(str(v)) for v in values if str(v).isdigit()]
    return min(1.0, max(0.0, sum(found) / len(found) / 100)) if found else 0.5


_default: list[Callable[[], OcrProvider]] = [TesseractProvider]


def default_provider() -> OcrProvider:
    """The provider of runs that name none; unavailable where Tesseract isn't installed."""
    return _default[0]()


def set_default_provider(make: Callable[[], OcrProvider]) -> None:
    _default[0] = make


def recognition_available() -> bool:
    return default_provider().is_available()


def read_page(image: bytes, page_number: int = 1, provider: OcrProvider | None = None) -> OcrResult:
    """An image as a page: an error, or an exception of the provider, is a result without confidence."""
    p = provider or default_provider()
    try:
        r = p.read_image(image)
    except Exception as e:
        r = OcrResult(provider_id=p.provider_id, error=str(e))
    return replace(r, page_number=page_number, confidence=0.0 if r.error else min(1.0, max(0.0, r.confidence)))


def merge_text(native: Column, ocr: Column, confidence: Column) -> Column:
    """A struct text, method, confidence from a page's own text and the recognised one."""
    n, o = strip(F.coalesce(native, F.lit(""))), strip(F.coalesce(ocr, F.lit("")))
    pick = lambda t, m, c: F.struct(t.alias("text"), F.lit(m).alias("method"), c.cast("double").alias("confidence"))
    return (
        F.when((n != "") & (o != ""), pick(normalize_whitespace(F.concat(n, F.lit("\n\n"), o)), "hybrid", F.least(F.lit(1.0), (0.95 + confidence) / 2)))
        .when(o != "", pick(o, "ocr", confidence))
        .when(n != "", pick(n, "parse", F.lit(0.35)))
        .otherwise(pick(F.lit(""), "parse", F.lit(0.0)))
    )


def recognise(flagged: DataFrame, files: DataFrame, provider: Callable[[], OcrProvider] = default_provider) -> DataFrame:
    """document_id, page_number, text, method and confidence of pages that need recognition.

    flagged: document_id, page_number, kind (pdf or image) and text, the page's own; files: document_id and content.
    A task gets PAGES pages of a file with one copy of its bytes, so a long file is spread and no page carries the file.
    PDF pages merge with their own text; without a provider it stays, at 0.3, or 0.0 if there is none. Images have no
    text of their own: they are read or empty. An exception of the provider is a page without recognised text.
    """
    place = F.row_number().over(_in_document()) - 1
    runs = flagged.withColumn("run", F.floor(place / PAGES)).groupBy("document_id", "kind", "run").agg(F.sort_array(F.collect_list(F.struct("page_number", "text"))).alias("pages"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = provider()
        able = p.is_available()
        for b in batches:
            for doc, kind, pages, content in zip(b["document_id"], b["kind"], b["pages"], b["content"], strict=True):
                out = []
                for page in pages:
                    number = int(page["page_number"])
                    try:
                        r = OcrResult(error="provider unavailable") if not able else p.read_image(bytes(content)) if kind == "image" else p.read_pdf_page(bytes(content), number)
                    except Exception as e:  # a page's failure is a value, not a task's
                        r = OcrResult(provider_id=p.provider_id, error=str(e))
                    out.append((doc, number, kind, page["text"], r.text, 0.0 if r.error else r.confidence, able))
                yield pd.DataFrame(out, columns=["document_id", "page_number", "kind", "text", "ocr", "c", "able"])

    seen = runs.join(files.select("document_id", "content"), "document_id").repartition("document_id", "run").select("document_id", "kind", "pages", "content").mapInPandas(read, "document_id string, page_number int, kind string, text string, ocr string, c double, able boolean")
    ocr = normalize_whitespace(F.col("ocr"))
    kept = F.struct(F.col("text"), F.lit("parse").alias("method"), F.when(strip(F.col("text")) != "", 0.3).otherwise(0.0).alias("confidence"))
    image = F.struct(ocr.alias("text"), F.lit("ocr").alias("method"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("c"))).alias("confidence"))
    found = F.when(F.col("kind") == "image", image).when(F.col("able"), merge_text(F.col("text"), ocr, F.col("c"))).otherwise(kept)
    return seen.select("document_id", "page_number", found.alias("m")).select("document_id", "page_number", "m.*")


def _in_document():
    from pyspark.sql import Window

    return Window.partitionBy("document_id").orderBy("page_number")

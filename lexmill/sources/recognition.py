"""Page images and recognised lines, through pluggable backends.

A rasteriser turns the bytes of a file into pages and a detector a page into boxes with text. Both are Python
objects made once per worker by a factory; images never pass through a shuffle, for rasterising and detecting
are one stage that emits lines only. A file that fails is a row with ``error``, not a failed task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PageImage:
    page_number: int
    width: int
    height: int
    rgb: bytes


class Rasteriser(Protocol):
    def pages(self, content: bytes, dpi: int, max_pages: int | None) -> tuple[int, Iterable[PageImage]]:
        """The full number of pages, and the images of at most ``max_pages`` of them (none or 0: all)."""


class Detector(Protocol):
    def detect(self, page: PageImage) -> list[tuple[list[list[float]], str, float]]:
        """Boxes (corner points), texts and confidences, in the detector's order."""


class BackendMissing(RuntimeError):
    """A backend's libraries are not installed."""


def pymupdf_rasteriser() -> Rasteriser:
    """A rasteriser on PyMuPDF, where that is installed."""
    try:
        import fitz
    except ImportError as e:
        raise BackendMissing("PyMuPDF is not installed") from e

    class Pages:
        def pages(self, content: bytes, dpi: int, max_pages: int | None):
            doc = fitz.open(stream=content, filetype="pdf")
            total = doc.page_count

            def images():
                for k in range(min(total, max_pages or total)):
                    p = doc.load_page(k).get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72), alpha=False)
                    yield PageImage(k + 1, p.width, p.height, p.samples)

            return total, images()

    return Pages()


def detections(files: DataFrame, rasteriser: Callable[[], Rasteriser], detector: Callable[[], Detector], dpi: int = 200, max_pages: int | None = None, id_type: str = "bigint") -> DataFrame:
    """``doc_id, page_count, page_number, det_ord, box, text, conf, error`` of ``files(doc_id, content)``; pages without text
    and failed files have one row with a null ``det_ord``."""
    columns = ["doc_id", "page_count", "page_number", "det_ord", "box", "text", "conf", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raster, detect = None, None
        for batch in batches:
            for doc, content in zip(batch["doc_id"], batch["content"]):
                try:
                    raster, detect = raster or rasteriser(), detect or detector()
                    total, images = raster.pages(bytes(content), dpi, max_pages)
                    empty = True
                    for page in images:
                        rows = [(doc, total, page.page_number, k, b, t, float(c), None) for k, (b, t, c) in enumerate(detect.detect(page))]
                        empty = False
                        yield pd.DataFrame(rows or [(doc, total, page.page_number, None, None, None, None, None)], columns=columns)
                    if empty:
                        yield pd.DataFrame([(doc, total, None, None, None, None, None, None)], columns=columns)
                except Exception as e:  # noqa: BLE001
                    yield pd.DataFrame([(doc, None, None, None, None, None, None, str(e)[:4000])], columns=columns)

    schema = f"doc_id {id_type}, page_count int, page_number int, det_ord int, box array<array<double>>, text string, conf double, error string"
    return files.select("doc_id", "content").mapInPandas(run, schema)


def model_listed(names: list[str], model: str) -> bool:
    """Whether a server's list of models has ``model``, or one of its family."""
    return any(model in n or n.startswith(model.partition(":")[0]) for n in names)


def http_backend(base_url: str, model: str, system: str, timeout: int = 600) -> Callable[[str], str]:
    """A completion function for a model server that takes a prompt and answers in JSON; an empty answer is an error."""

    def ask(prompt: str) -> str:
        import json
        import urllib.request

        body = {"model": model, "prompt": prompt, "system": system, "stream": False, "format": "json", "options": {"temperature": 0.0}}
        request = urllib.request.Request(f"{base_url.rstrip('/')}/api/generate", json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            text = json.load(reply).get("response", "")
        if not text:
            raise RuntimeError("empty answer")
        return text

    return ask


def served_models(base_url: str, timeout: int = 10) -> list[str]:
    """The models a server has."""
    import json
    import urllib.request

    with urllib.request.urlopen(f"{base_url.rstrip('/')}/api/tags", timeout=timeout) as reply:
        return [m.get("name", "") for m in json.load(reply).get("models", [])]

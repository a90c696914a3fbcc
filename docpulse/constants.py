"""Fixed values of the data model: names, limits, thresholds and small lookup tables."""

from __future__ import annotations

from dataclasses import dataclass

# Storage areas a file can live in.
SOURCE = "source"
PROCESSED = "processed"
FAILED = "failed"
INCOMING = "incoming"
REJECTED = "rejected"
PROCESSED_RAW = "processed-raw"

# Batch sizes of the two loops.
INGEST_MAX_FILES = 50
QUALITY_MAX_FILES = 20

# Confidence buckets of the reports.
LOW_CONFIDENCE = 0.70
HIGH_CONFIDENCE = 0.90

# Scoring.
PENALTY = {"ERROR": 30, "WARNING": 10, "INFO": 2}
BANDS = [(90, "excellent"), (75, "good"), (50, "fair"), (25, "poor")]
LAST_BAND = "unusable"

# Extensions by kind, and those allowed in pro mode.
KIND_EXTENSIONS = {
    "pdf": [".pdf"],
    "image": [".jpg", ".jpeg", ".jpe", ".png", ".bmp", ".heif", ".heic", ".tiff", ".tif"],
    "office": [".docx", ".xlsx", ".pptx"],
    "text": [".txt", ".html", ".htm", ".md", ".rtf", ".eml", ".msg", ".xml"],
}
PRO_EXTENSIONS = KIND_EXTENSIONS["pdf"] + KIND_EXTENSIONS["image"]

# Leading bytes per extension, as hex; HEIF brands may sit anywhere in the head.
SIGNATURES = {
    ".pdf": [b"%PDF-"],
    ".png": [b"\x89PNG\r\n\x1a\n"],
    ".jpg": [b"\xff\xd8\xff"],
    ".jpeg": [b"\xff\xd8\xff"],
    ".jpe": [b"\xff\xd8\xff"],
    ".bmp": [b"BM"],
    ".tif": [b"II*\x00", b"MM\x00*"],
    ".tiff": [b"II*\x00", b"MM\x00*"],
    ".docx": [b"PK\x03\x04"],
    ".xlsx": [b"PK\x03\x04"],
    ".pptx": [b"PK\x03\x04"],
}
HEIF_EXTENSIONS = [".heif", ".heic"]
HEIF_BRANDS = ["ftypheic", "ftypheix", "ftyphevc", "ftypmif1", "ftypmsf1"]
HEAD_BYTES = 32

# Fixed value: pixels beyond which an image is refused undecoded, as a likely decompression bomb; counts as one that cannot be opened.
MOST_PIXELS = 178_956_970

# Content types sent with a raw file.
CONTENT_TYPES = {
    ".pdf": "application/pdf",
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".jpe": "image/jpeg",
    ".bmp": "image/bmp",
    ".tif": "image/tiff",
    ".tiff": "image/tiff",
    ".heic": "image/heic",
    ".heif": "image/heif",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".txt": "text/plain",
    ".html": "text/html",
    ".htm": "text/html",
    ".md": "text/markdown",
    ".rtf": "application/rtf",
    ".eml": "message/rfc822",
    ".msg": "application/vnd.ms-outlook",
    ".xml": "application/xml",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# Where each leaf type keeps its value.
VALUE_KEYS = {
    "string": "valueString",
    "number": "valueNumber",
    "integer": "valueInteger",
    "date": "valueDate",
    "time": "valueTime",
    "boolean": "valueBoolean",
    "currency": "valueCurrency",
    "address": "valueAddress",
    "selectionMark": "valueSelectionMark",
}
ADDRESS_PARTS = ["streetAddress", "city", "state", "postalCode", "countryRegion"]

# Text limits of the sinks.
ERROR_MESSAGE_CHARS = 4000
ISSUE_MESSAGE_CHARS = 2000
OUTCOME_MESSAGE_CHARS = 3900

MB = 1024 * 1024


@dataclass(frozen=True)
class Limits:
    """Thresholds of the quality rules (fixed values; scaled down in tests and on small texts)."""

    max_bytes_pdf: int = 200 * MB
    max_bytes_image: int = 200 * MB
    max_bytes_office: int = 200 * MB
    max_bytes_text: int = 1 * MB
    max_bytes_pro: int = 100 * MB
    max_pages: int = 300
    max_pages_pro: int = 150
    max_chars_office: int = 1_000_000
    max_chars_text: int = 1_000_000
    chars_per_page: int = 3_000
    image_min_side: int = 50
    image_max_side: int = 10_000
    image_low_resolution: int = 1_000
    image_blur: float = 50.0
    image_contrast: float = 15.0
    white_mean: float = 230.0
    black_mean: float = 25.0
    page_sample: int = 100
    low_text_chars: int = 50
    empty_chars: int = 5
    min_avg_chars: int = 200
    low_text_ratio: float = 0.30
    scan_sample: int = 5
    scan_blur: float = 200.0
    scan_contrast: float = 12.0
    scan_skew: float = 2.0
    scan_skew_confidence: float = 1.15
    scan_dpi: float = 150.0


LIMITS = Limits()

# Widths of the stored text columns, in UTF-16 units.
DOCUMENT_WIDTHS = {
    "usecase": 128,
    "analyzer_name": 256,
    "analyzer_id": 256,
    "document_name": 512,
    "blob_path": 1024,
    "content_path": 256,
    "mime_type": 128,
    "api_version": 32,
    "operation_id": 64,
    "status": 32,
}
FIELD_WIDTHS = {
    "field_path": 512,
    "field_name": 256,
    "parent_path": 512,
    "field_type": 32,
    "currency_code": 8,
}

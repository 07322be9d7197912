"""Queries of this subpackage, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from . import ann, bpe, media, neardup, packing, quality, secrets, urls, warc, wrapper

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_transport_stream": media.op2_transport_stream,
    "op3_main_text": wrapper.op3_main_text,
    "op4_bpe": bpe.op4_bpe,
    "op5_nearest": ann.op5_nearest,
    "op6_quality": quality.op6_quality,
    "op7_warc": warc.op7_warc,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op9_url_filter": urls.op9_url_filter,
    "op10_packing": packing.op10_packing,
}

ORACLE = {
    "op7_warc": warc.ORACLE,
    "op9_url_filter": urls.ORACLE,
}

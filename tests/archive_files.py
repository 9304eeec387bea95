"""Writes small archives, one gzip member per record, for the tests."""

import gzip
from pathlib import Path

HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"


def record(body, rid, kind="response", uri="http://a.org/", http=HTTP, extra="", version="1.0"):
    payload = http + body
    headers = [f"WARC/{version}", f"WARC-Type: {kind}"]
    if uri:
        headers.append(f"WARC-Target-URI: {uri}")
    headers += [f"WARC-Record-ID: {rid}", "WARC-Date: 2024-01-01T00:00:00Z"]
    headers += [extra] if extra else []
    headers.append(f"Content-Length: {len(payload)}")
    head = "\r\n".join(headers) + "\r\n\r\n"
    return gzip.compress(head.encode() + payload + b"\r\n\r\n")


def write(root, segment, name, *records, crawl="CRAWL"):
    folder = Path(root) / "crawl-data" / crawl / "segments" / segment / "warc"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(b"".join(records))
    return str(folder / name)

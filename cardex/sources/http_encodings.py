"""HTTP transfer and content encodings of single response bodies."""

import re
import zlib

_CHUNK_SIZE = re.compile(rb"[ \t]*([0-9A-Fa-f]+)[ \t]*(?:;[^\r\n]*)?\r?\n")
_WINDOWS = {
    "gzip": [16 + zlib.MAX_WBITS],
    # zlib wrapped as it should be, or bare as some servers send it
    "deflate": [zlib.MAX_WBITS, -zlib.MAX_WBITS],
}


class TooLong(Exception):
    """A body that inflates beyond what one value can hold."""


def undo_encodings(message: bytes, most: int) -> bytes:
    """An HTTP message with its body dechunked and decompressed.

    A body that is not in the encoding its header names is left as it is; one that
    breaks off keeps what could be decoded.  Raises ``TooLong`` for a body that inflates
    beyond ``most`` bytes.
    """
    end = re.search(rb"\r?\n\r?\n", message)
    if end is None or not message.startswith(b"HTTP/"):
        return message
    head, body = message[: end.end()], message[end.end() :]
    headers = {}
    for line in head.decode("latin-1").splitlines()[1:]:
        name, _, value = line.partition(":")
        headers.setdefault(name.strip().lower(), value.strip().lower())
    if headers.get("transfer-encoding") == "chunked":
        body = _dechunked(body)
    for window in _WINDOWS.get(headers.get("content-encoding"), []):
        decoded = _inflated(body, window, most)
        if decoded is not None:
            return head + decoded
    return head + body


def _dechunked(body: bytes) -> bytes:
    chunks, position = [], 0
    while size := _CHUNK_SIZE.match(body, position):
        length = int(size[1], 16)
        if length == 0:
            break
        chunks.append(body[size.end() : size.end() + length])
        position = size.end() + length
        position += len(re.compile(rb"\r?\n|").match(body, position)[0])
    return b"".join(chunks) if chunks or size else body


def _inflated(body: bytes, window: int, most: int) -> bytes | None:
    """All gzip members or the one deflate stream; None if not even its start is."""
    decoded, size, position = [], 0, 0
    rest = memoryview(body)
    while position < len(rest):
        stream = zlib.decompressobj(window)
        try:
            # in pieces, so that what precedes damage is kept
            while position < len(rest) and not stream.eof:
                piece = rest[position : position + 16384]
                decoded.append(stream.decompress(piece))
                position += len(piece) - len(stream.unused_data)
                size += len(decoded[-1])
                if size > most:
                    raise TooLong
        except zlib.error:
            return b"".join(decoded) if any(decoded) else None
        if window < 16 or not stream.eof:
            break
    return b"".join(decoded)

"""Optional media libraries: what is there, and what therefore can be done. Decoding and
encoding are out of scope where no library is installed; callers get a plain report."""

from __future__ import annotations

import importlib.util

#: Video encoders in the order they are tried (fixed values).
ENCODERS = ("imageio_ffmpeg", "imageio", "cv2")
LIBRARIES = ("pyarrow", "av", "PIL", *ENCODERS)


def dependencies() -> dict[str, bool]:
    return {n: importlib.util.find_spec(n) is not None for n in LIBRARIES}


def readiness(found: dict[str, bool] | None = None) -> dict[str, bool | str | None]:
    d = found or dependencies()
    encoder = next((e for e in ENCODERS if d.get(e)), None)
    return {"parquet": bool(d.get("pyarrow")), "video": encoder is not None, "encoder": encoder, "decode_images": bool(d.get("PIL")), "decode_video": bool(d.get("av"))}

"""Media URL checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the host that media must be on.
MEDIA_HOST = "cloudinary.com"


def host_contains(url: Column, host: str = MEDIA_HOST) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))).contains(host), F.lit(False))


def path_ends(url: Column, suffix: str = ".mp3") -> Column:
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.substring_index(url, "?", 1))
    return F.coalesce(F.lower(path).endswith(suffix), F.lit(False))


def media_reason(url: Column, host: str = MEDIA_HOST, suffix: str = ".mp3") -> Column:
    """Why a URL is refused; null if it isn't."""
    on_host, named = host_contains(url, host), path_ends(url, suffix)
    return (
        F.when(~on_host & ~named, "AUDIO_NOT_CLOUDINARY_AND_NOT_MP3")
        .when(~on_host, "AUDIO_NOT_CLOUDINARY")
        .when(~named, "AUDIO_NOT_MP3")
    )

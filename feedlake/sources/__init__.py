from feedlake.sources.layout import (
    Layout,
    rows_between,
    with_offsets,
    write_layout,
)
from feedlake.sources.paged import (
    DEFAULT_PAGE_SIZE,
    PagedFeed,
    RequestFeed,
    SeekFeed,
    read_feed,
    register_feed,
)
from feedlake.sources.published import (
    drop_publications,
    publications,
    publish_stage,
    read_published,
)
from feedlake.sources.staged import decode_json, encode_json, read_stage, write_stage

__all__ = [
    "DEFAULT_PAGE_SIZE",
    "Layout",
    "PagedFeed",
    "RequestFeed",
    "SeekFeed",
    "decode_json",
    "drop_publications",
    "encode_json",
    "publications",
    "publish_stage",
    "read_feed",
    "read_published",
    "read_stage",
    "register_feed",
    "rows_between",
    "with_offsets",
    "write_layout",
    "write_stage",
]

"""Table layouts as DDL, declared once and enforced on read."""

LINES = "value string"
# Fixed value: the layout of the stored pages.
API_PAGE = "items array<struct<snippet:struct<resourceId:struct<videoId:string>>>>, nextPageToken string"
TRANSCRIPTS = "video_id string, segments array<struct<text:string,start:double,duration:double>>"
SCRIPTS = "video_id string, text string, timestamp double, duration double"
SCRIPT_COLUMNS = ("video_id", "text", "timestamp", "duration")

# The tables of a saved index. Vectors are stored in single precision; distances are
# always computed in double precision.
SEGMENTS = "ordinal bigint, script_id string, video_id string, timestamp double, text string, ord_block bigint"
POSTINGS = "cluster_id string, script_id string, rank bigint, distance double, vector array<float>"
POSTINGS_BY_LEVEL2 = POSTINGS + ", lv2_id string"
LV1 = "cluster_id string, centroid array<double>"
LV1_BY_LEVEL2 = LV1 + ", lv2_id string"
LV2 = "lv2_id string, centroid array<double>"

MEMBER_CHUNKS = "chunk_id string, cluster_id string, chunk_no bigint, n bigint, members array<string>"
PUBLISHED = "script_id string, video_id string, timestamp double, text string, vector array<float>"
RESULTS = (
    "query_id bigint, rank int, distance double, script_id string, video_id string, at string, text string"
)

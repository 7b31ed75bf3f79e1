"""Sources: relational endpoints and reads, document collections, key scans."""

from .documents import DocumentStore, bucket_collection, read_collection, read_named_collection, replace_documents, save_collection
from .endpoint import Endpoint, EndpointError
from .jdbc import read_db2, read_jdbc, read_mysql, read_postgres
from .keys import glob_to_regex, key_scan, keyed_view, write_key_layout

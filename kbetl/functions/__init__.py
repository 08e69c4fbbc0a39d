from .columns import conform, empty_to_null, strict_cast, valid_json
from .json_tree import BLOBS, entry_blobs

__all__ = ["BLOBS", "conform", "empty_to_null", "entry_blobs", "strict_cast", "valid_json"]

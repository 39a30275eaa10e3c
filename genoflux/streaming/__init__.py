"""The feed stage over files landed in a folder (Structured Streaming).

The reference is a batch program; its only incremental mechanism is the
fingerprint diff of a whole feed against the previous snapshot.  This
package runs that same feed stage on newly landed feed files with a
file-source stream and an ``availableNow`` trigger.
"""

from .feed import feed_stream, process_landed_feed

__all__ = ["feed_stream", "process_landed_feed"]

"""setgraph: text, graph and set-similarity analytics on Spark DataFrames."""

from .functions import path_string, prefix_length, split_lines, tokenize
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _ops
from .session import checkpoint_dir, configure, local_session
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _srcs

__all__ = [*_ops, *_srcs, "checkpoint_dir", "configure", "local_session", "path_string", "prefix_length",
           "split_lines", "tokenize"]

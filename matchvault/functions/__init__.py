from matchvault.functions.exprs import *  # noqa: F401,F403
from matchvault.functions.keys import data_hash, hash_key  # noqa: F401

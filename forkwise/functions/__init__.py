"""Column functions of the chain domain, and the trie helpers that need Python."""

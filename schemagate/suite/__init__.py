"""The registered queries, their fault-injected inputs and their SQL counterparts."""

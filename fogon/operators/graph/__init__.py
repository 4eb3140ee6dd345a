"""Graph tables (one DataFrame per node label and edge type) and their analytics.

A node is identified by (id, source_db): ids of the two sources overlap. All patterns have a fixed length
of at most two hops, so they are joins.
"""

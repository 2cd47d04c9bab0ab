"""Text work on package descriptions and notes: cleaning, matching, tokens and training windows.

Nothing outside this folder imports it.  Every operator takes a DataFrame with a key and a text
column; the defaults name a collected package (``package_key``, ``description``), the free text a
source prints under one fare family.
"""

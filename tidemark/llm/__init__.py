"""Operators for text corpora: repeats, near copies, secrets, decontamination, quality, pages, chats and mixing."""

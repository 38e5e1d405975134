"""Readers and writers of pages, attachments, points and job logs."""

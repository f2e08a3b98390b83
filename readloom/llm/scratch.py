"""The library's own store of tables in the shared folder."""

from readloom.scratch import Scratch, delete, shared_folder, shuffles_removed

__all__ = ["Scratch", "delete", "shared_folder", "shuffles_removed"]

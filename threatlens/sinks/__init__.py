"""Writers: points, messages and files. These run jobs."""
